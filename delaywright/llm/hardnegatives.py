"""Hard negatives by inner product, from an R-tree packed by sort-tile-recursive.

Rows are sorted along one coordinate into slabs of even size (ties by a hash of the id, so that
copies spread over slabs); inside a slab, tiles are cut along further coordinates and packed into
leaves, and neighbouring leaves into nodes. The minimum bounding box of a node gives, coordinate by
coordinate, an interval of products with an anchor, and their sum an interval of scores.

A search keeps nodes in a queue by the greatest score their box allows. It ends when that lies
strictly below the k-th score found or below the score window, and passes over boxes that lie
above the window as a whole. Slabs are searched in the same order in two rounds: every anchor asks the slab of
the greatest bound first; the others are asked only where their bounds reach the k-th score.

All scores are exact integers.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaywright.runtime import spool

#: Rows of a slab, which one task packs and searches. Slabs grow beyond ``MAX_SLABS`` of them: the
#: slabs' boxes, two vectors each, are what the driver and every task know of the whole table.
ROWS_PER_SLAB = 8192
MAX_SLABS = 8192
ROWS_PER_LEAF = 128
FANOUT = 16
#: Coordinates that tiles are cut along, those of the greatest variance.
TILED = 4
#: Anchors that search a slab in one task.
ANCHORS_PER_TASK = 4096


@dataclass(frozen=True)
class Settings:
    """A negative scores from ``least_percent`` to ``most_percent`` of its positive's score.
    Components become floor(``scale`` * x)."""

    positives: int = 5
    negatives: int = 3
    least_percent: int = 50
    most_percent: int = 95
    scale: int = 256


# ---------------------------------------------------------------- boxes and the tree


def tile_order(x: np.ndarray, ids: np.ndarray, axes: list[int], leaf: int) -> np.ndarray:
    """The rows of ``x`` in sort-tile-recursive order: any ``leaf`` neighbours make a tile."""
    found = []

    def cut(rows: np.ndarray, axes: list[int]) -> None:
        if axes:
            rows = rows[np.lexsort((ids[rows], x[rows, axes[0]]))]
        tiles = -(-len(rows) // leaf)
        if tiles <= 1 or len(axes) <= 1:
            found.append(rows)
            return
        slices = math.ceil(tiles ** (1 / len(axes)))
        step = leaf * -(-tiles // slices)
        for at in range(0, len(rows), step):
            cut(rows[at : at + step], axes[1:])

    cut(np.arange(len(x)), list(axes))
    return np.concatenate(found)


def bounds(anchor: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest score that each box allows with an anchor."""
    plus, minus = np.maximum(anchor, 0), np.minimum(anchor, 0)
    return low @ plus + high @ minus, high @ plus + low @ minus


class Tree:
    """A slab's rows in tile order, and boxes level by level from the leaves up to one root."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, leaf: int = ROWS_PER_LEAF):
        self.ids, self.labels, self.x, self.leaf = ids, labels, x, leaf
        starts = np.arange(0, len(x), leaf)
        self.levels = [(np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts))]
        while len(self.levels[-1][0]) > 1:
            low, high = self.levels[-1]
            starts = np.arange(0, len(low), FANOUT)
            self.levels.append((np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))


class Searcher:
    """Best-first searches of one anchor in one tree; a leaf's scores are computed once."""

    def __init__(self, tree: Tree, anchor: np.ndarray):
        self._tree, self._anchor = tree, anchor
        self._bounds = [tuple(b.tolist() for b in bounds(anchor, low, high)) for low, high in tree.levels]
        self._scores: dict[int, np.ndarray] = {}

    def best(self, allowed: np.ndarray, k: int, low: float = -math.inf, high: float = math.inf) -> list[tuple[int, int]]:
        """The ``k`` highest (score, id) of ``allowed`` rows with ``low <= score <= high``, equal
        scores by ascending id."""
        tree, found = self._tree, []
        top = len(tree.levels) - 1
        queue = [(-self._bounds[top][1][0], top, 0)]
        least = low
        while queue:
            bound, level, node = heapq.heappop(queue)
            if -bound < least:
                break
            if level:
                lows, highs = self._bounds[level - 1]
                for child in range(node * FANOUT, min((node + 1) * FANOUT, len(highs))):
                    if highs[child] >= least and lows[child] <= high:
                        heapq.heappush(queue, (-highs[child], level - 1, child))
                continue
            rows = slice(node * tree.leaf, (node + 1) * tree.leaf)
            if node not in self._scores:
                self._scores[node] = tree.x[rows] @ self._anchor
            scores = self._scores[node]
            met = np.flatnonzero((scores >= least) & (scores <= high) & allowed[rows])
            if len(met):
                found += zip((-scores[met]).tolist(), tree.ids[rows][met].tolist(), strict=True)
                found = heapq.nsmallest(k, found)
                if len(found) == k:
                    least = -found[-1][0]
        return [(int(-s), i) for s, i in found]


# ---------------------------------------------------------------- packing the table


def prepare(table: DataFrame, scale: int) -> DataFrame:
    """``vec_id, label, x``: the rows that take part, with their integer components."""
    broken = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~broken
    x = F.transform("embedding", lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return table.filter(F.coalesce(usable, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x")
    )


@dataclass(frozen=True)
class Shape:
    """Rows, components and the largest magnitude of the table; ``axes`` by falling variance."""

    rows: int
    width: int
    most: int
    axes: list[int]

    @property
    def kind(self) -> type:
        """Doubles add integers exactly below 2**53, and much faster."""
        reach = self.width * self.most**2
        if reach >= 1 << 63:
            raise ValueError("inner products of these vectors do not fit 64 bits")
        return np.float64 if reach < 1 << 53 else np.int64


def measure(rows: DataFrame) -> Shape:
    """One pass; each task sends a few numbers for each coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            total = sums.setdefault(-1, [0, 0.0, 0.0, 0])
            total[0] += batch.num_rows
            lists = batch.column("x")
            length = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            at = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
            if len(flat):
                wide = flat.astype(np.float64)
                n, s, q = np.bincount(at), np.bincount(at, wide), np.bincount(at, wide * wide)
                most = np.zeros(len(n), dtype=np.uint64)
                np.maximum.at(most, at, np.abs(flat).astype(np.uint64))
                for c in range(len(n)):
                    own = sums.setdefault(c, [0, 0.0, 0.0, 0])
                    own[0] += int(n[c])
                    own[1] += float(s[c])
                    own[2] += float(q[c])
                    own[3] = max(own[3], int(min(most[c], np.uint64((1 << 63) - 1))))
        columns = [list(sums), *([v[i] for v in sums.values()] for i in range(4))]
        kinds = [pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["c", "n", "s", "q", "most"])

    parts = rows.mapInArrow(run, "c int, n long, s double, q double, most long")
    found = parts.groupBy("c").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.max("most").alias("most")).collect()
    n = next((r["n"] for r in found if r["c"] < 0), 0)
    own = sorted((r for r in found if r["c"] >= 0), key=lambda r: (-(r["q"] - r["s"] ** 2 / max(n, 1)), r["c"]))
    return Shape(n, len(own), max((r["most"] for r in own), default=0), [r["c"] for r in own[:TILED]])


def _matrix(column: pa.Array | pa.ChunkedArray, width: int, kind: type) -> np.ndarray:
    """Rows of ``width`` components; shorter ones end in zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.zeros((len(lists), width), dtype=kind)
    length = np.diff(lists.offsets.to_numpy())
    x[np.repeat(np.arange(len(lists)), length), np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)] = lists.flatten().to_numpy()
    return x


_TILES = "slab int, leaf int, ids array<long>, labels array<long>, x array<long>, low array<long>, high array<long>"


def pack(rows: DataFrame, shape: Shape, rows_per_slab: int = ROWS_PER_SLAB) -> DataFrame:
    """The packed tree: a row for each leaf with its vectors end to end, and a row for each slab's
    box (``leaf`` -1)."""
    slabs = min(MAX_SLABS, max(1, -(-shape.rows // rows_per_slab)))
    axes = [*shape.axes[1:], *shape.axes[:1]]
    width, kind = shape.width, shape.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab = TaskContext.get().partitionId()
        table = pa.Table.from_batches([b for b in batches if b.num_rows] or [], schema=_ROWS).combine_chunks()
        if not table.num_rows:
            return
        x, ids, labels = _matrix(table.column("x"), width, np.int64), table.column("vec_id").to_numpy(), table.column("label").to_numpy()
        order = tile_order(x, ids, axes, ROWS_PER_LEAF)
        x, ids, labels = x[order], ids[order], labels[order]
        out: list[list] = [[slab], [-1], [[]], [[]], [[]], [x.min(axis=0)], [x.max(axis=0)]]
        for leaf, at in enumerate(range(0, len(x), ROWS_PER_LEAF)):
            part = slice(at, at + ROWS_PER_LEAF)
            row = (slab, leaf, ids[part], labels[part], x[part].ravel(), None, None)
            for column, value in zip(out, row, strict=True):
                column.append(value)
        kinds = [pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 5]
        names = [c.split()[0] for c in _TILES.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    dealt = rows.repartitionByRange(slabs, F.get("x", F.lit(shape.axes[0] if shape.axes else 0)), F.xxhash64("vec_id"))
    return spool(dealt.mapInArrow(run, _TILES), "tiles")


_ROWS = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("x", pa.list_(pa.int64()))])


# ---------------------------------------------------------------- searching it

_ASKED = "slab int, anchor_id long, label long, x array<long>, windows array<struct<rank:int,low:long,high:long,least:long>>"
_FOUND = "anchor_id long, window int, vec_id long, score long"


@dataclass(frozen=True)
class Boxes:
    """The boxes of all slabs."""

    slabs: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _boxes(tiles: DataFrame, shape: Shape) -> Boxes:
    found = tiles.filter("leaf = -1").select("slab", "low", "high").orderBy("slab").collect()
    low, high = (np.array([r[c] for r in found], dtype=shape.kind).reshape(len(found), shape.width) for c in ("low", "high"))
    return Boxes(np.array([r["slab"] for r in found], dtype=np.int64), low, high)


def _deal(anchors: DataFrame, boxes: Boxes, shape: Shape, first: bool) -> DataFrame:
    """``anchors`` repeated for every slab that they have to ask: in the first round the one of the
    greatest bound, then the others whose bounds reach into a window above its ``least`` score."""
    width, kind = shape.width, shape.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, slabs = [], []
            windows = batch.column("windows").to_pylist()
            for i, a in enumerate(_matrix(batch.column("x"), width, kind)):
                low, high = bounds(a, boxes.low, boxes.high)
                home = int(high.argmax()) if len(high) else None
                if first:
                    asked = [] if home is None else [home]
                else:
                    reached = np.zeros(len(high), dtype=bool)
                    for w in windows[i]:
                        reached |= (high >= w["least"]) & (low <= w["high"])
                    if home is not None:
                        reached[home] = False
                    asked = np.flatnonzero(reached).tolist()
                take += [i] * len(asked)
                slabs += boxes.slabs[asked].tolist() if asked else []
            rows = pa.array(take, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(slabs, pa.int32()), *(batch.column(c).take(rows) for c in ("anchor_id", "label", "x", "windows"))], ["slab", "anchor_id", "label", "x", "windows"])

    return anchors.select("anchor_id", "label", "x", "windows").mapInArrow(run, _ASKED)


def _ask(asked: DataFrame, tiles: DataFrame, shape: Shape, same: bool, k: int) -> DataFrame:
    """The best ``k`` rows of each window in every slab asked, of the anchor's label or of others."""
    width, kind = shape.width, shape.kind

    def run(anchors: pa.Table, leaves: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if anchors.num_rows and leaves.num_rows:
            leaves = leaves.sort_by("leaf").combine_chunks()
            ids, labels, flat = (leaves.column(c).combine_chunks().flatten().to_numpy() for c in ("ids", "labels", "x"))
            tree = Tree(ids, labels, flat.reshape(len(ids), width).astype(kind))
            keys, own = anchors.column("anchor_id").to_numpy(), anchors.column("label").to_numpy()
            for i, a in enumerate(_matrix(anchors.column("x"), width, kind)):
                allowed = (labels == own[i]) & (ids != keys[i]) if same else labels != own[i]
                searcher = Searcher(tree, a)
                for w in anchors.column("windows")[i].as_py():
                    for score, vec_id in searcher.best(allowed, k, w["least"], w["high"]):
                        for column, value in zip(out, (int(keys[i]), w["rank"], vec_id, score), strict=True):
                            column.append(value)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["anchor_id", "window", "vec_id", "score"])

    counts = asked.groupBy("slab").agg(F.ceil(F.count(F.lit(1)) / ANCHORS_PER_TASK).cast("int").alias("parts"))
    parts = F.broadcast(counts)  # at most MAX_SLABS rows
    visitors = asked.join(parts, "slab").withColumn("part", F.pmod(F.xxhash64("anchor_id"), F.col("parts")).cast("int")).drop("parts")
    visited = tiles.filter("leaf >= 0").join(parts, "slab").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return (
        visitors.groupBy("slab", "part")
        .cogroup(visited.select("slab", "part", "leaf", "ids", "labels", "x").groupBy("slab", "part"))
        .applyInArrow(run, _FOUND)
    )


def _rank(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each anchor's window, numbered in ``place``."""
    order = Window.partitionBy("anchor_id", "window").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _search(anchors: DataFrame, tiles: DataFrame, boxes: Boxes, shape: Shape, same: bool, k: int, tag: str) -> DataFrame:
    """``anchor_id, window, vec_id, score, place``, in two rounds over the slabs."""
    near = spool(_rank(_ask(_deal(anchors, boxes, shape, True), tiles, shape, same, k), k), f"{tag}-near")
    reached = near.groupBy("anchor_id", "window").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("least"))
    least = reached.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("window", "least"))).alias("known"))
    # At least the k-th score so far; rows that equal it may still win by their ids.
    raised = F.transform(
        "windows",
        lambda w: F.struct(w["rank"].alias("rank"), w["low"].alias("low"), w["high"].alias("high"), F.greatest(w["least"], F.try_element_at("known", w["rank"])).alias("least")),
    )
    waiting = anchors.join(least, "anchor_id", "left").select("anchor_id", "label", "x", raised.alias("windows"))
    far = _ask(_deal(waiting, boxes, shape, False), tiles, shape, same, k)
    return spool(_rank(near.drop("place").unionByName(far), k), tag)


_ANY = (1 << 63) - 1


def mine(table: DataFrame, anchors: DataFrame, settings: Settings = Settings(), rows_per_slab: int = ROWS_PER_SLAB) -> DataFrame:
    """Hard negatives of each row of ``anchors`` among the rows of ``table`` (both ``vec_id, label,
    embedding``): ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    An anchor's positives are the highest inner products among the other rows of its label. For
    each, the highest-scoring rows of other labels follow that score from ``least_percent`` to
    ``most_percent`` of the positive's score. Ties go to the smaller id.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. A shorter
    vector counts as if it ended in zeros. Rows of ``table`` that repeat an id are candidates of
    their own, but an anchor is never its own positive; anchors that repeat an id are asked once,
    with the smallest label and vector. Scores beyond 64 bits are an error. Empty tables, and anchors
    without positives or negatives, give no rows; other columns are not read.
    """
    rows = prepare(table, settings.scale)
    asking = prepare(anchors, settings.scale)
    shape = measure(rows.unionByName(asking))
    tiles = pack(rows, shape, rows_per_slab)
    boxes = _boxes(tiles, shape)
    asked = asking.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("own"))
    anywhere = F.array(F.struct(F.lit(0).alias("rank"), F.lit(-_ANY).cast("long").alias("low"), F.lit(_ANY).alias("high"), F.lit(-_ANY).cast("long").alias("least")))
    asked = spool(asked.select(F.col("vec_id").alias("anchor_id"), "own.label", F.col("own.x").alias("x"), anywhere.alias("windows")), "anchors")
    positives = _search(asked, tiles, boxes, shape, True, settings.positives, "positives")

    # The windows as integers: the products are compared before any division.
    low = F.expr(f"-((-{settings.least_percent} * score - pmod(-{settings.least_percent} * score, 100)) div 100)")
    high = F.expr(f"({settings.most_percent} * score - pmod({settings.most_percent} * score, 100)) div 100")
    windows = positives.withColumn("low", low).withColumn("high", high).filter("low <= high")
    per_anchor = windows.groupBy("anchor_id").agg(
        F.collect_list(F.struct(F.col("place").alias("rank"), "low", "high", F.col("low").alias("least"))).alias("windows")
    )
    windowed = spool(asked.drop("windows").join(per_anchor, "anchor_id"), "windows")
    negatives = _search(windowed, tiles, boxes, shape, False, settings.negatives, "negatives")
    named = positives.select("anchor_id", F.col("place").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.join(named, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def oracle_sql(settings: Settings = Settings()) -> str:
    """DuckDB SQL for :func:`mine` of every 50th row of ``embeddings``, relabelled as the query does."""
    return f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({settings.scale} * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {settings.positives})
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {settings.least_percent} * positive_score <= 100 * score AND 100 * score <= {settings.most_percent} * positive_score
QUALIFY rank <= {settings.negatives}
"""
