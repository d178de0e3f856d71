"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample and then holds every vector: each row descends to a leaf.
A query walks the tree through a priority queue of nodes by the cosine of their centres, so that
leaves come up in order of promise, and visits as many leaves as calibration asks for: on sample
queries with known neighbours the visits are widened until ``recall`` of the neighbours are found.

Leaves are joined with their queries in blocks: a leaf beyond ``block`` rows, or with more queries,
is split on either side, so a leaf that holds a third of all rows is many tasks' work. Neighbouring
leaves of the tree, which a query mostly visits together, share a block; it returns each query's
best ``k`` of all of them, and the best of all blocks follow by rank.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaywright.llm.vectors import is_valid, matrix, unit

#: The fit reads about this many rows; more would sharpen the tree but not change what is indexed.
SAMPLE = 20_000
LEAF = 512
BRANCHES = 8
RECALL = 0.97
BLOCK = 4096
#: Neighbouring leaves (or pieces of them, at most ``BLOCK`` rows each) that share a task.
LEAVES_PER_TASK = 16
_SEED = 20_261


@dataclass
class Node:
    """``leaf`` numbers a leaf; an inner node has children and their unit centres."""

    leaf: int = -1
    centres: np.ndarray | None = None
    children: list[Node] = field(default_factory=list)


@dataclass
class Tree:
    root: Node
    n_leaves: int

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each unit row: always the child with the nearest centre."""
        found = np.empty(len(x), dtype=np.int32)
        stack = [(self.root, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if node.leaf >= 0:
                found[rows] = node.leaf
                continue
            best = (x[rows] @ node.centres.T).argmax(axis=1)
            stack += [(child, rows[best == c]) for c, child in enumerate(node.children)]
        return found

    def best_bins(self, q: np.ndarray) -> Iterator[int]:
        """Leaves by best bin first for a unit query."""
        queue: list[tuple[float, int, Node]] = [(0.0, 0, self.root)]
        pushed = 1
        while queue:
            _, _, node = heapq.heappop(queue)
            if node.leaf >= 0:
                yield node.leaf
                continue
            for near, child in zip((node.centres @ q).tolist(), node.children, strict=True):
                heapq.heappush(queue, (-near, pushed, child))
                pushed += 1


def fit_tree(x: np.ndarray, leaf_rows: float, branches: int = BRANCHES) -> Tree:
    """A tree over unit rows whose leaves hold at most ``leaf_rows`` of them, as far as they
    differ: rows that no centres can tell apart stay together."""
    draw = np.random.default_rng(_SEED)
    leaves = 0

    def grow(rows: np.ndarray) -> Node:
        nonlocal leaves
        if len(rows) > leaf_rows and len(rows) > 1:
            centres, owner = _kmeans(x[rows], branches, draw)
            if len(centres) > 1:
                return Node(-1, centres, [grow(rows[owner == c]) for c in range(len(centres))])
        leaves += 1
        return Node(leaves - 1)

    root = grow(np.arange(len(x)))
    return Tree(root, leaves)


def _kmeans(x: np.ndarray, k: int, draw: np.random.Generator, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: (unit centres with rows, the centre of each row)."""
    centres = x[[draw.integers(len(x))]]
    while len(centres) < min(k, len(x)):
        # The next start is drawn by distance from the centres so far.
        far = np.maximum(0.0, 1.0 - (x @ centres.T).max(axis=1))
        far[far < 1e-12] = 0.0
        if not far.sum():
            break
        centres = np.concatenate([centres, x[[draw.choice(len(x), p=far / far.sum())]]])
    owner = (x @ centres.T).argmax(axis=1)
    for _ in range(steps):
        used = np.unique(owner)
        sums = np.stack([x[owner == c].sum(axis=0) for c in used])
        length = np.linalg.norm(sums, axis=1)
        sums[length < 1e-9] = centres[used][length < 1e-9]
        centres = unit(sums)
        new = (x @ centres.T).argmax(axis=1)
        if len(centres) == len(used) and (new == np.searchsorted(used, owner)).all():
            owner = new
            break
        owner = new
    used, owner = np.unique(owner, return_inverse=True)
    return centres[used], owner


def calibrate(tree: Tree, x: np.ndarray, k: int, recall: float, queries: int = 300) -> int:
    """The fewest leaf visits that find ``recall`` of the ``k`` nearest other rows of ``x``, over
    evenly chosen query rows."""
    if len(x) < 2:
        return tree.n_leaves
    leaf = tree.assign(x)
    chosen = np.unique(np.linspace(0, len(x) - 1, min(queries, len(x))).astype(int))
    found = np.zeros(tree.n_leaves + 1)
    near = x[chosen] @ x.T
    near[np.arange(len(chosen)), chosen] = -np.inf
    top = np.argpartition(-near, min(k, len(x) - 1) - 1, axis=1)[:, : min(k, len(x) - 1)]
    for row, q in enumerate(chosen):
        rank = {v: n for n, v in enumerate(tree.best_bins(x[q]))}
        for v in leaf[top[row]].tolist():
            found[rank[v] + 1] += 1
    share = np.cumsum(found) / found.sum()
    return int(min(tree.n_leaves, np.searchsorted(share, recall)))


def _top(near: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` largest entries of each row, and of all within rounding of the last;
    returned as a mask."""
    if near.shape[1] <= k:
        return near > -np.inf
    last = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
    return (near >= last[:, None] - 1e-12) & (near > -np.inf)


def _blocks(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The best ``k`` rows (right) for each query (left), of all leaves that it visits here."""
    leaves = [np.unique(t.column("leaf").to_numpy()) for t in (left, right)]
    parts = [_block(*(t.filter(pc.equal(t.column("leaf"), int(leaf))) for t in (left, right)), k) for leaf in np.intersect1d(*leaves)]
    found = pa.concat_tables(parts or [_block(left.slice(0, 0), right.slice(0, 0), k)])
    keys, ids, scores = (found.column(c).to_numpy() for c in ("query_id", "vec_id", "score"))
    order = np.lexsort((ids, -scores, keys))
    place = np.arange(len(order)) - np.searchsorted(keys[order], keys[order])
    return found.take(pa.array(order[place < k]))


def _block(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The best ``k`` of a block of rows (right) for each of a block of queries (left)."""
    out: list[list] = [[], [], []]
    if left.num_rows and right.num_rows:
        q, x = matrix(left.column("query")), matrix(right.column("embedding"))
        keys, ids = left.column("query_id").to_numpy(), right.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        x, ids = x[order], ids[order]
        uq, ux = unit(q), unit(x)
        for at in range(0, len(q), 256):
            near = uq[at : at + 256] @ ux.T
            near[keys[at : at + 256][:, None] == ids[None, :]] = -np.inf
            row, column = np.nonzero(_top(near, ids, k))
            exact = cosines(q[at + row], x[column])
            ranked = np.lexsort((ids[column], -exact, row))
            row, column, exact = row[ranked], column[ranked], exact[ranked]
            n = np.arange(len(row)) - np.searchsorted(row, row)
            best = n < k
            out[0].append(keys[at + row[best]])
            out[1].append(ids[column[best]])
            out[2].append(exact[best])
    kinds = (np.int64, np.int64, np.float64)
    found = [np.concatenate(c) if c else np.empty(0, dtype=t) for c, t in zip(out, kinds, strict=True)]
    return pa.table(dict(zip(["query_id", "vec_id", "score"], found, strict=True)))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, on vectors first scaled by their largest component."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def search(
    table: DataFrame,
    queries: DataFrame,
    k: int = 5,
    recall: float = RECALL,
    sample: int = SAMPLE,
    leaf_rows: int = LEAF,
    block: int = BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` the ``k`` nearest found rows
    of ``table`` (both ``vec_id, embedding``) with another id, by cosine, ties to the smaller id.

    Null, zero, null-holding and non-finite vectors and null ids take no part, nor do vectors of
    another length than the most frequent one (the smaller, if two are). A query with fewer other
    rows than ``k`` gets them all. Rows that repeat an id are candidates of their own; query rows
    that repeat an id are answered once, for the smallest of their vectors. Empty tables give no rows; other columns are not read.
    """
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(is_valid())
    asked = queries.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(is_valid())
    lengths = rows.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()
    if not lengths:
        return asked.limit(0).select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        )
    most = max(lengths, key=lambda r: (r["n"], -r["dim"]))
    dim, n = most["dim"], most["n"]
    rows, asked = rows.filter(F.size("embedding") == dim), asked.filter(F.size("embedding") == dim)
    # A bounded sample by a hash of the vector: copies are drawn together, and fitted once.
    part = F.pmod(F.xxhash64("embedding"), F.lit(1 << 30)) < int(min(1.0, sample / n) * (1 << 30))
    drawn = rows.select("embedding").distinct()
    if n > sample:
        # The order makes the limit the same in every run.
        drawn = rows.filter(part).select("embedding").distinct().orderBy(F.xxhash64("embedding"), "embedding").limit(2 * sample)
    x = unit(np.array([r["embedding"] for r in drawn.orderBy("embedding").collect()], dtype=np.float64).reshape(-1, dim))
    if not len(x):
        x = np.eye(1, dim)
    tree = fit_tree(x, max(4.0, leaf_rows * len(x) / n))
    visits = calibrate(tree, x, k, recall)

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.assign(unit(matrix(batch.column("embedding")))) if batch.num_rows else np.empty(0, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), *batch.columns], ["leaf", "vec_id", "embedding"])

    kind = table.schema["embedding"].dataType.simpleString()
    placed = rows.mapInArrow(descend, f"leaf int, vec_id long, embedding {kind}")
    held = np.zeros(tree.n_leaves, dtype=np.int64)
    for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect():
        held[r["leaf"]] = r["n"]
    pieces = np.maximum(1, -(-held // block))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit(matrix(batch.column("embedding"))) if batch.num_rows else []
            take, leaves = [], []
            for i, q in enumerate(x):
                seen = rows_seen = 0
                for leaf in tree.best_bins(q):
                    # Widened further only while fewer rows than asked for have been met.
                    if seen >= visits and rows_seen > k:
                        break
                    seen += 1
                    rows_seen += held[leaf]
                    if held[leaf]:
                        take.append(i)
                        leaves.append(leaf)
            chosen = pa.array(take, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaves, pa.int32()), batch.column("vec_id").take(chosen), batch.column("embedding").take(chosen)],
                ["leaf", "query_id", "query"],
            )

    walks = asked.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).mapInArrow(walk, f"leaf int, query_id long, query {kind}")
    parts = np.ones(tree.n_leaves, dtype=np.int64)
    for r in walks.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect():
        parts[r["leaf"]] = -(-r["n"] // block)
    # One entry for each leaf, bounded by the tree, which the sample bounds; found by the leaf's number.
    split, split_q = (F.get(F.array(*[F.lit(int(v)) for v in counts]), F.col("leaf")) for counts in (pieces, parts))
    piece = F.pmod(F.xxhash64("vec_id"), split).cast("int")
    piece_q = F.pmod(F.xxhash64("query_id"), split_q).cast("int")
    shared = F.expr(f"leaf div {LEAVES_PER_TASK}").cast("int").alias("leaves")
    index = placed.select(
        "leaf", shared, piece.alias("piece"), F.explode(F.sequence(F.lit(0), split_q - 1)).alias("part"), "vec_id", "embedding"
    )
    visitors = walks.select(
        "leaf", shared, F.explode(F.sequence(F.lit(0), split - 1)).alias("piece"), piece_q.alias("part"), "query_id", "query"
    )
    key = ["leaves", "piece", "part"]
    found = (
        visitors.groupBy(*key)
        .cogroup(index.groupBy(*key))
        .applyInArrow(lambda a, b: _blocks(a, b, k), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def index_rows(table: DataFrame, tree: Tree) -> DataFrame:
    """``leaf, vec_id`` of every usable row of ``table`` under a fitted tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.assign(unit(matrix(batch.column("embedding")))) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), batch.column("vec_id")], ["leaf", "vec_id"])

    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(is_valid())
    return rows.mapInArrow(run, "leaf int, vec_id long")
