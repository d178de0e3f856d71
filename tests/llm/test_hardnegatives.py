"""Hard negatives against all pairs, and the tree on its own."""

import math

import numpy as np
import pytest

from delaywright.llm import hardnegatives
from delaywright.llm.hardnegatives import ROWS_PER_LEAF, Searcher, Settings, Tree, mine, tile_order

SCHEMA = "vec_id long, embedding array<float>, label int, slab int, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], k, 0, "") for i, v, k in rows], SCHEMA)


def brute(rows, anchors, s=Settings()):
    def usable(r):
        return None not in (r[0], r[1], r[2]) and all(c is not None and math.isfinite(c) for c in r[1])

    def whole(rows):
        return [(i, [math.floor(s.scale * float(np.float32(c))) for c in v], k) for i, v, k in rows if usable((i, v, k))]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    asked = {}
    for i, v, k in whole(anchors):
        asked[i] = min(asked.get(i, (k, v)), (k, v))
    found = []
    for a, (label, v) in asked.items():
        scored = sorted((-score(v, w), i, k) for i, w, k in whole(rows))
        for p, positive in [(-x, i) for x, i, k in scored if k == label and i != a][: s.positives]:
            fit = [(-x, i) for x, i, k in scored if k != label and s.least_percent * p <= -100 * x <= s.most_percent * p]
            found += [(a, positive, rank, i, p, n) for rank, (n, i) in enumerate(fit[: s.negatives], 1)]
    return sorted(found)


def rows_of(found):
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("rows_per_slab", [8192, 100])
def test_equals_brute_force(spark, rows_per_slab):
    draw = np.random.default_rng(2)
    centres = draw.standard_normal((6, 8))
    x = centres[draw.integers(0, 6, 700)] + draw.choice([0.0, 0.05, 0.4], 700)[:, None] * draw.standard_normal((700, 8))
    # Copies of one vector in every label, and rows that take no part.
    x[:200] = x[0]
    labels = draw.integers(0, 4, 700)
    rows = [(3 * i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, labels, strict=True))]
    rows += [(5000, None, 1), (5001, [math.nan] * 8, 1), (5002, [math.inf] + [1.0] * 7, 1), (5003, [None] + [1.0] * 7, 1), (5004, [1.0] * 8, None), (None, [1.0] * 8, 1)]
    rows += [(5005, [0.0] * 8, 1), (5006, [2.0, 1.0], 2), (5007, [], 2), (3, x[5].tolist(), 0), (3, x[5].tolist(), 0)]
    anchors = rows[::40] + rows[-11:]
    found = mine(frame(spark, rows), frame(spark, anchors), rows_per_slab=rows_per_slab)
    assert rows_of(found) == brute(rows, anchors)


def test_empty_tables_and_lonely_anchors(spark):
    none, one = frame(spark, []), frame(spark, [(1, [1.0, 2.0], 3)])
    for table, anchors in ((none, none), (one, none), (none, one), (one, one)):
        assert mine(table, anchors).collect() == []
    pair = [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [0.75, 0.0], 1), (4, [0.75, 0.0], 1), (5, [0.95, 0.5], 2), (6, [0.96, 0.0], 2)]
    assert rows_of(mine(frame(spark, pair), frame(spark, pair[:1]))) == brute(pair, pair[:1])


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(i, [2.0**20 + i % 3, 1.0 + i], i % 2) for i in range(40)]
    assert rows_of(mine(frame(spark, rows), frame(spark, rows[:3]))) == brute(rows, rows[:3])
    with pytest.raises(ValueError, match="64 bits"):
        mine(frame(spark, [(1, [1e30], 1)]), frame(spark, [(1, [1e30], 1)]))


def test_tiles_are_packed_and_searched_exactly():
    draw = np.random.default_rng(8)
    x = draw.integers(-50, 50, (3000, 5))
    order = tile_order(x, np.arange(3000), [2, 0, 4], ROWS_PER_LEAF)
    assert sorted(order.tolist()) == list(range(3000))
    x, labels = x[order].astype(float), draw.integers(0, 3, 3000)
    tree = Tree(order, labels, x)
    first = slice(0, ROWS_PER_LEAF)
    assert np.ptp(x[first, 2]) < np.ptp(x[:, 2]) / 2 and len(tree.levels) == 3
    for _ in range(30):
        a = draw.integers(-9, 9, 5).astype(float)
        low, high = sorted(draw.integers(-900, 900, 2).tolist())
        scores = x @ a
        allowed = labels == 1
        for lo, hi in ((-math.inf, math.inf), (low, high)):
            want = sorted((-int(s), int(i)) for s, i, ok in zip(scores, order, allowed, strict=True) if ok and lo <= s <= hi)[:4]
            assert Searcher(tree, a).best(allowed, 4, lo, hi) == [(-s, i) for s, i in want]


def test_boxes_prune(monkeypatch):
    """Separate clusters: most leaves are never scored."""
    draw = np.random.default_rng(1)
    centres = draw.integers(-200, 200, (40, 4))
    x = np.repeat(centres, 128, axis=0) + draw.integers(-3, 3, (40 * 128, 4))
    order = tile_order(x, np.arange(len(x)), [0, 1, 2, 3], ROWS_PER_LEAF)
    searcher = Searcher(Tree(order, np.zeros(len(x)), x[order].astype(float)), centres[0].astype(float))
    searcher.best(np.ones(len(x), dtype=bool), 5)
    assert len(searcher._scores) <= 10
    assert hardnegatives.FANOUT > 1
