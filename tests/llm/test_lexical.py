"""Ranked search against plain scoring of every pair, and the shard search on its own."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaywright.llm import lexical

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, top=50):
    own = [(key, Counter(plain_terms(text))) for key, text in docs]
    own = [(key, c) for key, c in own if c]
    n_docs, n_terms = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    asked = {}
    for key, text in items:
        if key is not None:
            asked.setdefault(key, set()).update(plain_terms(text))
    found = []
    for item, wanted in asked.items():
        scores = []
        for key, c in own:
            m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
            s = 0
            for t in wanted & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                s += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if s > 0 and key is not None:
                scores.append((-s, key))
        found += [(item, rank, key, -s) for rank, (s, key) in enumerate(sorted(scores)[:top], 1)]
    return sorted(found)


def items_frame(spark, pairs):
    return spark.createDataFrame([(i, t, 0) for i, t in pairs], "item_id long, text string, rank int")


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    odds = [1 / (i + 1) for i in range(300)]
    texts = [" ".join(draw.choices(words, odds, k=draw.randint(1, 60))) for _ in range(500)]
    texts += ["same text of w1 w2"] * 80 + [None, "", " .,- ", "É é W1-w2_W3", "x\x85y w9", "w0 " * 200_000 + "w7"]
    items = [(i, " ".join(draw.choices(words, k=draw.randint(1, 25)))) for i in range(12)]
    items += [(50, "w0"), (51, "no such"), (52, None), (53, ""), (None, "w1"), (54, "W1 w1 w2"), (54, "w40"), (55, "É"), (56, "w0 w1 w2 w3 same text of")]
    return list(enumerate(texts, 100)), items


@pytest.mark.parametrize("postings, reach, chars", [(4_000_000, 4096, 4_000_000), (600, 16, 200)])
def test_equals_brute_force(spark, make_docs, corpus, monkeypatch, postings, reach, chars):
    monkeypatch.setattr(lexical, "POSTINGS_PER_SHARD", postings)
    monkeypatch.setattr(lexical, "RANGE", reach)
    docs, items = corpus
    extra = [(None, "w1 w2 w3"), (100, "w1 w5"), (100, "w1 w5")]
    found = lexical.search(make_docs(docs + extra).withColumn("n", F.lit(1)), items_frame(spark, items), chars_per_block=chars)
    assert sorted(tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()) == brute(docs + extra, items)


@pytest.mark.parametrize("short", [0.0, 0.125, 1.0, 8.0])
@pytest.mark.parametrize("top", [1, 5])
def test_shard_search_equals_sums(monkeypatch, short, top):
    """From lists only to accumulators only, with many ties and lists that never matter."""
    monkeypatch.setattr(lexical, "SHORT", short)
    monkeypatch.setattr(lexical, "RANGE", 32)
    draw = np.random.default_rng(5)
    ids = np.arange(1000) * 3
    for _ in range(20):
        term, place, impact = [], [], []
        for t in range(12):
            held = np.flatnonzero(draw.random(1000) < draw.choice([0.002, 0.02, 0.3, 0.9]))
            term.append(np.full(len(held), t))
            place.append(held)
            impact.append(draw.integers(1, draw.choice([2, 50]) + 1, len(held)))
        order = np.argsort(np.concatenate(place), kind="stable")
        term, place, impact = (np.concatenate(x)[order] for x in (term, place, impact))
        weights = draw.integers(0, 20, 12)
        wanted = sorted(draw.choice(12, 7, replace=False).tolist())
        best = lexical.Best(top)
        lexical.search_shard(lexical.Shard(ids, term, place, impact), wanted, weights, best)
        used = np.isin(term, wanted)
        sums = np.bincount(place[used], weights=(weights[term] * impact)[used], minlength=1000).astype(int)
        want = sorted(((-s, i) for s, i in zip(sums.tolist(), ids.tolist(), strict=True) if s > 0))[:top]
        assert list(zip((-best.scores).tolist(), best.ids.tolist(), strict=True)) == want


def test_empty_tables(spark, make_docs):
    some, none = make_docs([(1, "a b")]), make_docs([])
    assert lexical.search(none, items_frame(spark, [(1, "a")])).collect() == []
    assert lexical.search(some, items_frame(spark, [])).collect() == []
    assert lexical.search(some, items_frame(spark, [(1, None)])).collect() == []
