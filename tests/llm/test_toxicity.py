"""Toxicity classifier: held-out accuracy, hashes, edge cases."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaywright.llm import toxicity

FILLER = "the of and to in that have with this from they would there their what about which when make like time just know take".split()
BAD = ["awfulword", "vileterm", "schimpf"]


@pytest.fixture(scope="module")
def labelled(spark):
    draw = random.Random(1)
    rows = []
    for i in range(900):
        words = [draw.choice(FILLER) for _ in range(draw.randint(3, 120))]
        toxic = int(draw.random() < 0.3)
        if toxic:
            for _ in range(draw.randint(1, 3)):
                words.insert(draw.randrange(len(words)), draw.choice(BAD).capitalize())
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels.filter(~toxicity.is_held_out(F.col("doc_id"))))
    return docs, {i: t for i, _, t in rows}, model


def test_held_out_accuracy(labelled):
    docs, truth, model = labelled
    found = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 100
    assert np.mean([(found[i] >= 0.5) == bool(truth[i]) for i in held]) > 0.97


def test_scores_do_not_depend_on_company(labelled):
    docs, _, model = labelled
    scorer = toxicity.Scorer(model)
    texts = [r.text for r in docs.limit(50).collect()] + ["", " ", "awfulword", "x" * 100_000, "é 日本 😀"]
    together = scorer.scores(texts)
    assert np.allclose(together, [scorer.scores([t])[0] for t in texts])
    assert together[50] == together[51] < 0.5 <= together[52]


def test_edge_cases(spark, make_docs, labelled):
    docs, _, model = labelled
    odd = make_docs([(1, None), (2, ""), (None, "awfulword vileterm"), (3, "awfulword " * 9000), (3, "awfulword " * 9000)])
    found = sorted((str(r.doc_id), r.score >= 0.5) for r in toxicity.score(odd, model).collect())
    assert found == [("1", False), ("2", False), ("3", True), ("3", True), ("None", True)]
    kept = toxicity.remove_toxic(odd, model)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert toxicity.score(make_docs([]), model).count() == 0
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0)):
        alone = toxicity.fit(docs, some)
        assert not len(alone.weights) and 0 < toxicity.Scorer(alone).scores(["text"])[0] <= 0.5


def test_ngram_hashes_are_by_order_and_content():
    codes = toxicity._codes("abcabc")
    for n, hashes in zip(toxicity.ORDERS, toxicity.ngram_hashes(codes), strict=True):
        text = " abcabc "
        grams = [text[i : i + n] for i in range(len(text) - n + 1)]
        assert len({*zip(grams, hashes.tolist(), strict=True)}) == len(set(grams)) == len(set(hashes.tolist()))


def test_given_labels_are_learnt(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.filter(~toxicity.is_held_out(F.col("doc_id"))))
    rows = toxicity.score(docs, model).join(labels, "doc_id").filter(toxicity.is_held_out(F.col("doc_id"))).collect()
    toxic = [r.score for r in rows if r.toxic]
    clean = [r.score for r in rows if not r.toxic]
    assert np.mean([a > b for a in toxic for b in clean]) > 0.85
    assert np.mean([s >= 0.5 for s in clean]) < 0.05


def plain_hash(gram):
    """The hash of an n-gram in plain integers."""
    state = 0
    for c in gram:
        state = (state * 0x9E3779B97F4A7C15 + ord(c) + 1) % 2**64
    mixed = (state + len(gram)) * 0xD6E8FEB86659FD93 % 2**64
    mixed ^= mixed >> 32
    return mixed * 0x9E3779B97F4A7C15 % 2**64


def plain_features(text):
    folded = " " + " ".join(text.lower().split()) + " "
    return {plain_hash(folded[i : i + n]) for n in toxicity.ORDERS for i in range(len(folded) - n + 1)}


def test_equals_a_plain_model(labelled):
    """Features, ratios, the fit and scores, all in plain Python."""
    docs, truth, model = labelled
    texts = {r.doc_id: r.text for r in docs.collect()}
    learnt = [i for i in truth if zlib.crc32(str(i).encode()) % 5]
    own = {i: plain_features(t) for i, t in texts.items()}
    sizes = [sum(truth[i] == k for i in learnt) for k in (0, 1)]
    ratio = {}
    for h in model.hashes.tolist():
        n = [sum(h in own[i] for i in learnt if truth[i] == k) for k in (0, 1)]
        assert sum(n) >= toxicity.MIN_ROWS
        # Classes below the bound of the sample are taken whole.
        ratio[h] = math.log((n[1] + 1) / (sizes[1] + 2)) - math.log((n[0] + 1) / (sizes[0] + 2))
    weight = dict(zip(model.hashes.tolist(), model.weights.tolist(), strict=True))

    def score(features):
        return 1 / (1 + math.exp(-(model.intercept + sum(weight[h] for h in features if h in weight))))

    found = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all(found[i] == pytest.approx(score(own[i]), abs=1e-6) for i in truth)
    order = model.hashes.tolist()
    x = np.array([[ratio[h] if h in own[i] else 0.0 for h in order] for i in learnt])
    fitted, intercept = plain_fit(x, np.array([truth[i] for i in learnt], dtype=float))
    assert fitted * np.array([ratio[h] for h in order]) == pytest.approx(model.weights, abs=1e-6)
    assert intercept == pytest.approx(model.intercept, abs=1e-6)


def plain_fit(x, y, steps=200):
    """Accelerated gradient with restarts on a dense matrix."""
    n, l2 = len(y), toxicity.L2
    step = 4.0 / (4 * np.mean((x * x).sum(axis=1) + 1) + l2 / n)
    w = ahead = np.zeros(x.shape[1])
    b = ahead_b = 0.0
    momentum, last = 1.0, np.inf
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead + ahead_b, -50, 50)))
        loss = -np.mean(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12)) + l2 / (2 * n) * ahead @ ahead
        if loss > last:
            momentum, step, ahead, ahead_b, last = 1.0, step * 0.7, w, b, np.inf
            continue
        last = loss
        new, new_b = ahead - step * (x.T @ (p - y) / n + l2 / n * ahead), ahead_b - step * np.mean(p - y)
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, ahead_b = new + (momentum - 1) / after * (new - w), new_b + (momentum - 1) / after * (new_b - b)
        w, b, momentum = new, new_b, after
    return w, b
