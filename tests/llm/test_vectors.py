"""Vector search and vector near-duplicates against brute force."""

import math

import numpy as np
import pytest

from delaywright.llm import annsearch, crosspolytope
from delaywright.llm.vectors import unit

SCHEMA = "vec_id long, embedding array<float>, label int, links long, leaf int"
ODD = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]


def frame(spark, ids, x, labels):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], k, 0, 0) for i, v, k in zip(ids, x, labels, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def clustered(seed, n, d=16):
    """Clusters of every tightness, exact copies, and spread-out vectors."""
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((12, d))
    noise = draw.choice([0.0, 0.1, 0.25, 0.4, 1.5], n)
    x = centres[draw.integers(0, 12, n)] + noise[:, None] * draw.standard_normal((n, d))
    return x.astype(np.float32), draw.integers(0, 3, n)


def brute_links(ids, x, labels):
    u = unit(x.astype(np.float64))
    near = (u @ u.T >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(x))])
        if (new == label).all():
            break
        label = new
    return {int(i): (int(n), int(ids[c])) for i, n, c in zip(ids, near.sum(axis=1), label, strict=True)}


@pytest.mark.parametrize("block", [64, 2048])
def test_near_duplicates_equal_brute_force(spark, block):
    x, labels = clustered(5, 500)
    ids = np.arange(500) * 2
    rows = frame(spark, ids.tolist(), x, labels.tolist())
    odd = frame(spark, range(2001, 2001 + len(ODD)), ODD, [0] * len(ODD)).unionByName(
        frame(spark, [None, 3001], [x[0], x[1]], [int(labels[0]), None])
    )
    found = crosspolytope.near_duplicates(rows.unionByName(odd), block=block).collect()
    assert len(found) == 500 + len(ODD) + 2
    want = brute_links(ids, x, labels) | {2001 + i: (0, 2001 + i) for i in range(len(ODD))} | {None: (0, None), 3001: (0, 3001)}
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_no_vectors_and_few(spark):
    empty = frame(spark, [], [], [])
    assert crosspolytope.near_duplicates(empty).count() == 0
    assert annsearch.search(empty, empty).count() == 0
    two = frame(spark, [5, 5, 6], [[1.0, 0.0]] * 2 + [[-0.0, 1.0]], [1, 1, 1])
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in crosspolytope.near_duplicates(two).collect()) == [
        (5, 1, 5), (5, 1, 5), (6, 0, 6),
    ]
    assert [tuple(r) for r in annsearch.search(two, two.filter("vec_id = 5")).collect()] == [(5, 1, 6, 0.0)]


def test_forest_connects_what_pairs_connect():
    draw = np.random.default_rng(3)
    for _ in range(50):
        n = int(draw.integers(1, 40))
        i, j = draw.integers(0, n, (2, int(draw.integers(0, 50))))
        label = np.arange(n)
        for _ in range(n):
            for a, b in zip(i, j, strict=True):
                label[a] = label[b] = min(label[a], label[b])
        assert (crosspolytope._forest(n, i, j) == label).all()


def test_rotations_keep_angles():
    x = np.random.default_rng(1).standard_normal((20, 16))
    y = crosspolytope.Hasher(16, 1, 1, 1)._rotated(x, 0, 0)
    assert np.allclose(x @ x.T, y @ y.T)


def test_search_recall_ties_and_scores(spark):
    x, labels = clustered(6, 1500)
    rows = frame(spark, range(1500), x, labels.tolist())
    odd = frame(spark, range(1550, 1550 + len(ODD)), ODD, [0] * len(ODD))
    table = rows.unionByName(odd).unionByName(frame(spark, [None], [x[0]], [0]))
    found = annsearch.search(table, table.filter("vec_id % 50 = 0"), k=5, leaf_rows=64, block=100).collect()
    u = unit(x.astype(np.float64))
    by_query = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by_query.setdefault(r.query_id, []).append(r)
    assert set(by_query) == set(range(0, 1500, 50))
    hits = 0
    for q, got in by_query.items():
        assert [r["rank"] for r in got] == [1, 2, 3, 4, 5] and all(r.vec_id != q for r in got)
        keys = [(-round(r.score, 12), r.vec_id) for r in got]
        assert keys == sorted(keys)
        near = u @ u[q]
        assert all(math.isclose(r.score, near[r.vec_id], abs_tol=1e-9) for r in got)
        near[q] = -2
        hits += len({r.vec_id for r in got} & set(np.lexsort((np.arange(1500), -near.round(12)))[:5].tolist()))
    assert hits >= 0.9 * 5 * len(by_query)


def test_fewer_rows_than_asked_for(spark):
    table = frame(spark, range(4), np.eye(4, 16), [0] * 4)
    found = annsearch.search(table, table.filter("vec_id = 0"), leaf_rows=1).collect()
    assert sorted((r["rank"], r.vec_id) for r in found) == [(1, 1), (2, 2), (3, 3)]
