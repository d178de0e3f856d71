"""Exact duplicates against a dictionary of texts, and the perfect hash on its own."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaywright.llm import exactdedup


def words_of(keys):
    return np.frombuffer(b"".join(hashlib.sha256(k).digest() for k in keys), dtype="<u8").reshape(-1, 4)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 20_000])
def test_hash_is_minimal_and_perfect(n):
    own = words_of([b"%d" % i for i in range(n)])
    found = exactdedup.perfect_hash(own)
    assert sorted(found.slots(own).tolist()) == list(range(n))
    assert int(found.bits.sum()) == n and len(found.bits) < 5 * n + 200
    other = found.slots(words_of([b"x%d" % i for i in range(1000)]))
    assert other.min() >= -1 and other.max() < max(n, 1)


def test_repeated_digests_are_refused():
    with pytest.raises(ValueError):
        exactdedup.perfect_hash(np.repeat(words_of([b"a"]), 2, axis=0))


def brute(pairs):
    groups = defaultdict(list)
    for key, text in pairs:
        groups[text or ""].append(key)
    found = []
    for key, text in pairs:
        own = groups[text or ""]
        known = [k for k in own if k is not None]
        found.append((key, max(known) if known else None, len(own), hashlib.sha256((text or "").encode()).hexdigest()))
    return found


def plain(rows):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr)


@pytest.mark.parametrize("held", [None, "doc_id % 3 = 0", "true", "false"])
def test_equals_brute_force(make_docs, held):
    draw = random.Random(3)
    texts = [f"text {draw.randrange(150)}" for _ in range(400)] + ["copy"] * 200 + ["", None, " ", "É", "é", "long " * 300_000, "long " * 300_000]
    draw.shuffle(texts)
    pairs = list(enumerate(texts, 7))
    condition = None if held is None else F.expr(held)
    # Small shards and salts, so that several of both are used.
    found = exactdedup.exact_duplicates(make_docs(pairs), condition, rows_per_shard=64, rows_per_task=50).collect()
    assert plain(found) == sorted(brute(pairs), key=repr)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


def test_repeated_and_null_ids(make_docs):
    pairs = [(4, "a"), (4, "a"), (4, "b"), (None, "a"), (None, "c"), (None, "c"), (9, None), (2, "")]
    docs = make_docs(pairs)
    found = exactdedup.exact_duplicates(docs).collect()
    assert plain(found) == sorted(brute(pairs), key=repr)
    assert sorted((r.text_sha256[:2], r.keep_id) for r in found if r.kept) == sorted(
        (hashlib.sha256(t.encode()).hexdigest()[:2], k) for t, k in (("a", 4), ("b", 4), ("c", None), ("", 9))
    )
    kept = exactdedup.keep_one(docs.withColumn("digest", F.lit(1)).withColumn("owner", F.lit("x")))
    assert kept.columns == [*docs.columns, "digest", "owner"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(4, "a"), (4, "b"), (None, "c"), (9, None)], key=repr)


def test_empty_table(make_docs):
    docs = make_docs([])
    assert exactdedup.exact_duplicates(docs).collect() == []
    assert exactdedup.keep_one(docs).collect() == []


def test_the_index_tells_known_digests_from_new_ones(make_docs):
    rows = exactdedup.digests(make_docs([(i, f"t{i % 40}") for i in range(100)]), F.col("doc_id") < 30)
    index = exactdedup.build_index(rows.filter("held"), 3)
    found = exactdedup.merge(index, rows.filter("not held")).collect()
    digest = {hashlib.sha256(f"t{i}".encode()).digest(): i for i in range(40)}
    assert {digest[bytes(r.digest)]: (r.known, r.keep_id, r.group_size) for r in found} == {
        i: (i < 30, max(k for k in range(100) if k % 40 == i), sum(k % 40 == i for k in range(100))) for i in range(40)
    }
