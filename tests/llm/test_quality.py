"""Quality classifier: the model against a plain Kneser-Ney, both ways of scoring, thresholds."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaywright.llm import quality

N = quality.ORDER


def plain_model(texts):
    """Interpolated modified Kneser-Ney by the textbook, on tuples."""
    counts = {N: Counter()}
    for t in texts:
        u = quality.units(t).tolist()
        counts[N].update(tuple(u[i : i + N]) for i in range(len(u) - N + 1))
    for k in range(N, 1, -1):
        counts[k - 1] = Counter(g[1:] for g in counts[k])

    def discount(k):
        n = [sum(1 for c in counts[k].values() if c == i) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
        raw = [1 - 2 * y * n[1] / n[0] if n[0] else 0.5, 2 - 3 * y * n[2] / n[1] if n[1] else 1.0, 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
        d = [min(max(x, 0.1), i + 0.9) for i, x in enumerate(raw)]
        return lambda c: d[min(c, 3) - 1]

    d = {k: discount(k) for k in counts}
    context = {k: defaultdict(list) for k in counts}
    for k, table in counts.items():
        for g, c in table.items():
            context[k][g[:-1]].append(c)
    total = sum(counts[1].values())
    unseen = sum(d[1](c) for c in counts[1].values()) / total / (len(counts[1]) + 1)

    def p(g):
        k = len(g)
        c = counts[k].get(g, 0)
        if k == 1:
            return unseen + (c - d[1](c)) / total if c else unseen
        of = context[k].get(g[:-1])
        if not of:
            return p(g[1:])
        own = (c - d[k](c)) / sum(of) if c else 0.0
        return own + sum(map(d[k], of)) / sum(of) * p(g[1:])

    def perplexity(text):
        u = quality.units(text).tolist()
        gs = [tuple(u[i : i + N]) for i in range(len(u) - N + 1)]
        return len(gs), math.exp(-sum(math.log(p(g)) for g in gs) / len(gs))

    return perplexity


def corpus(seed, n):
    draw = random.Random(seed)
    words = "the of and tion ing ähnlich café naïve 日本 über word letter number".split()
    return [" ".join(draw.choice(words) for _ in range(draw.randint(1, 30))) for _ in range(n)]


ODD = [None, "", "  ", "the", "THE  Of", "qqq zzz", "😀 日本語", "the of " * 3000, "x" * 500, "\u0000\t\n"]


@pytest.mark.parametrize("limit", [10**9, 0])
def test_perplexities_equal_a_plain_model(spark, make_docs, limit):
    trusted = corpus(1, 120)
    model = quality.train(spark.createDataFrame([(t,) for t in trusted], "text string"))
    pairs = [*enumerate(trusted[:20] + corpus(2, 20) + ODD), (2, trusted[2]), (None, "the of")]
    plain = plain_model(trusted)
    want = sorted(((k, *plain(t or "")) for k, t in pairs), key=repr)
    got = sorted(((r.doc_id, r.n_tokens, r.perplexity) for r in quality.perplexities(make_docs(pairs), model, limit).collect()), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-9)


def test_probabilities_sum_to_one(spark):
    trusted = corpus(3, 60)
    model = quality.train(spark.createDataFrame([(t,) for t in trusted], "text string"))
    t = model.table.toPandas()
    lookup = quality.Lookup(t.k.to_numpy().astype(np.uint8), t.gram.to_numpy().view(np.uint64), t.logp.to_numpy(), t.backoff.to_numpy(), model.unseen)
    seen = sorted({int(u) for x in trusted for u in quality.units(x)} - {quality._START})
    for context in ("the", "of ", "zzz"):
        u = [ord(c) for c in context]
        base = (u[0] << 48) | (u[1] << 32) | (u[2] << 16)
        every = lookup.scores(np.array([base | w for w in [*seen, 0xFFFE]], dtype=np.uint64))
        assert abs(np.exp(every).sum() - 1) < 1e-9


def test_classify(spark, make_docs):
    good = corpus(4, 200)
    junk = ["$$$ ### ;;; @@@ !!! " * 9] * 5
    docs = make_docs([*enumerate(good + junk), (900, None)])
    labels = spark.createDataFrame([(i, 1) for i in range(200)] + [(200, 0), (None, 1), (201, None)], "doc_id long, quality int")
    found = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(found) == 206
    assert sum(found[i].kept for i in range(200)) >= 195 and not any(found[i].kept for i in range(200, 205))
    nothing = quality.classify(docs, labels.limit(0)).collect()
    assert all(r.kept for r in nothing)
    assert quality.classify(make_docs([]), labels).count() == 0


def test_upper_threshold_comes_from_documents_left_out(spark, make_docs):
    docs = make_docs([*enumerate(corpus(6, 300))])
    labels = spark.createDataFrame([(i, 1) for i in range(300)], "doc_id long, quality int")
    found = quality.classify(docs, labels)
    left_out = F.pmod(F.xxhash64("doc_id"), F.lit(quality.LEFT_OUT)) == 0
    counted = [r.text for r in docs.filter(~left_out).collect()]
    assert 0 < len(counted) < 300
    plain = plain_model(counted)
    values = {r.doc_id: plain(r.text)[1] for r in docs.collect()}
    new = sorted(values[r.doc_id] for r in docs.filter(left_out).collect())
    every = sorted(values.values())
    row = found.first()
    at = {q: math.ceil(quality.HIGH * len(v)) - 1 for q, v in (("new", new), ("every", every))}
    assert row.highest == pytest.approx(max(new[at["new"]], every[at["every"]]))
    assert row.lowest == pytest.approx(every[0])


def test_languages_have_their_own_thresholds(spark):
    rows = [(i, t, "a") for i, t in enumerate(corpus(5, 50))] + [(100 + i, f"zeta {i} eta theta" * 3, "b") for i in range(50)]
    rows += [(200, "the of and", None), (201, "the of and", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], 1) for r in rows[:100]], "doc_id long, quality int")
    found = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert found[0].highest != found[100].highest
    assert found[200].highest == found[201].highest is not None
