"""Weighted directed graphs as edge lists ``(src, dst, weight)``: degrees, walks, PageRank.

Skew: a node may own a third of all edges. Sums over incoming edges use partial aggregation. For
the join of edges with the ranks of their sources, the edges of a heavy source are spread over
several salts and only that source's rank is repeated, once per salt.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaywright.operators.skew import ROWS_PER_TASK, OrderedScan, Position
from delaywright.runtime import cut_lineage, spool

#: Graphs up to this many edges are iterated in one task (about 50 bytes an edge).
EDGES_PER_GRAPH = 1_000_000


def edges_from(df: DataFrame, src: Column, dst: Column, weight: Column | None = None) -> DataFrame:
    """Aggregate rows into an edge list; the weight is the row count or a summed expression."""
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(src.alias("src"), dst.alias("dst")).agg(total.alias("weight"))


def nodes_of(edges: DataFrame) -> DataFrame:
    """All nodes, sources and destinations, one row each."""
    ends = F.explode(F.array("src", "dst")).alias("id")
    return edges.select(ends).distinct()


def node_count(edges: DataFrame) -> DataFrame:
    return nodes_of(edges).agg(F.count(F.lit(1)).alias("nodes"))


def out_degree(edges: DataFrame) -> DataFrame:
    """Weighted out-degree of every node that has out-links."""
    return edges.groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("out_degree"))


def top_out_degree(edges: DataFrame, k: int = 10) -> DataFrame:
    return out_degree(edges).orderBy(F.desc("out_degree"), F.asc("id")).limit(k)


def average_out_degree(edges: DataFrame) -> DataFrame:
    """Mean weighted out-degree over the nodes that have out-links."""
    return edges.agg((F.sum("weight") / F.count_distinct("src")).alias("avg_out_degree"))


def dangling_nodes(edges: DataFrame) -> DataFrame:
    """Nodes that are only destinations."""
    targets = edges.select(F.col("dst").alias("id")).distinct()
    sources = edges.select(F.col("src").alias("id")).distinct()
    return targets.join(sources, "id", "left_anti")


def dangling_ratio(edges: DataFrame) -> DataFrame:
    """Regular and dangling node counts and the dangling share, from one pass over node flags."""
    return _nodes_with_links(edges).agg(
        F.count_if("has_links").alias("regular"),
        F.count_if(~F.col("has_links")).alias("dangling"),
        F.avg((~F.col("has_links")).cast("double")).alias("dangling_ratio"),
    )


def _nodes_with_links(edges: DataFrame) -> DataFrame:
    ends = F.inline(
        F.array(
            F.struct(F.col("src").alias("id"), F.lit(1).alias("n")),
            F.struct(F.col("dst").alias("id"), F.lit(0).alias("n")),
        )
    )
    return edges.select(ends).groupBy("id").agg((F.sum("n") > 0).alias("has_links"))


def init_graph(edges: DataFrame) -> DataFrame:
    """One record per node including dangling ones: start rank ``1/N`` and out-degree.

    The records are written once; their number then comes from the file footers.
    """
    ends = F.inline(
        F.array(
            F.struct(F.col("src").alias("id"), F.col("weight").alias("w")),
            F.struct(F.col("dst").alias("id"), F.lit(0).cast("bigint").alias("w")),
        )
    )
    nodes = spool(edges.select(ends).groupBy("id").agg(F.sum("w").alias("out_degree")), "nodes")
    return nodes.withColumn("rank", F.lit(1.0 / max(nodes.count(), 1)))


def lookup_node(edges: DataFrame, node) -> DataFrame:
    """Out-links of one node; the predicate reaches the scan of a stored edge list."""
    return edges.filter(F.col("src") == F.lit(node)).agg(
        F.count(F.lit(1)).alias("neighbours"), F.sum("weight").alias("links")
    )


def transition_probabilities(edges: DataFrame) -> DataFrame:
    """Add ``p = weight / out-degree``; dangling nodes have no rows, that is, a zero row."""
    return _prepare(edges, ROWS_PER_TASK).edges.select("src", "dst", "weight", "p")


def adjacency_matrix(edges: DataFrame, nodes: list) -> DataFrame:
    """0/1 matrix with one column per node, zero rows kept. For small graphs with known nodes; an
    edge outside ``nodes`` is an error. Larger graphs have :func:`adjacency_entries`."""
    spark = edges.sparkSession
    if not edges.filter(~(F.col("src").isin(nodes) & F.col("dst").isin(nodes))).isEmpty():
        raise ValueError("an edge leads outside the given nodes")
    every = spark.createDataFrame([(n,) for n in nodes], f"node {edges.schema['src'].dataType.simpleString()}")
    marks = (
        edges.groupBy(F.col("src").alias("node")).pivot("dst", nodes).agg(F.lit(1))
    )
    return every.join(marks, "node", "left").select(
        "node", *[F.coalesce(F.col(f"`{n}`"), F.lit(0)).alias(f"to_{n}") for n in nodes]
    )


def adjacency_entries(edges: DataFrame) -> DataFrame:
    """The 0/1 matrix as rows ``(i, j, v)``, one for each entry that is not zero; for any graph."""
    return edges.filter("src IS NOT NULL AND dst IS NOT NULL").select(
        F.col("src").alias("i"), F.col("dst").alias("j"), F.lit(1).alias("v")
    ).distinct()


def adjacency_list(edges: DataFrame, per_record: int = 100_000) -> DataFrame:
    """``(id, part, neighbours)``: sorted neighbours, every node kept.

    Record ``part`` of a node holds its neighbours number ``part * per_record`` onwards, in order,
    at most ``per_record`` of them; a node without any has one empty record.
    """
    ordered = OrderedScan(["src"], ["dst"]).run(edges.select("src", "dst").distinct(), _at=Position())
    lists = ordered.groupBy(F.col("src").alias("id"), F.expr(f"int((_at - 1) div {per_record})").alias("part")).agg(
        F.sort_array(F.collect_list("dst")).alias("neighbours")
    )
    empty = F.array().cast(lists.schema["neighbours"].dataType)
    return (
        nodes_of(edges)
        .join(lists, "id", "left")
        .select("id", F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("neighbours", empty).alias("neighbours"))
    )


@dataclass
class _Links:
    """Edges with transition probabilities, laid out for repeated joins with their sources."""

    edges: DataFrame  # src, salt, dst, weight, p
    heavy: DataFrame | None  # id, slices of the sources that are spread over several salts


def _prepare(edges: DataFrame, edges_per_task: int, weighted: bool = True) -> _Links:
    base = edges if weighted else edges.withColumn("weight", F.lit(1).cast("bigint"))
    degree = cut_lineage(
        base.groupBy(F.col("src").alias("id")).agg(
            F.sum("weight").alias("degree"), F.count(F.lit(1)).alias("links")
        )
    )
    slices = F.ceil(F.col("links") / edges_per_task).cast("int")
    sliced = degree.select("id", "degree", slices.alias("slices"))
    # never more than edges / edges_per_task rows, so it can be broadcast
    heavy = sliced.filter(F.col("slices") > 1).select("id", "slices")
    if heavy.isEmpty():
        joined = base.join(sliced, base["src"] == sliced["id"]).select(
            "src", F.lit(0).alias("salt"), "dst", "weight", (F.col("weight") / F.col("degree")).alias("p")
        )
        return _Links(joined, None)
    salted = _salted(base, heavy, "src", F.pmod(F.xxhash64("dst"), F.col("_slices")))
    repeated = sliced.select(
        F.col("id").alias("_id"),
        "degree",
        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("_salt"),
    )
    match = (salted["src"] == repeated["_id"]) & (salted["salt"] == repeated["_salt"])
    joined = salted.join(repeated, match).select(
        "src", "salt", "dst", "weight", (F.col("weight") / F.col("degree")).alias("p")
    )
    return _Links(joined, heavy)


def _salted(df: DataFrame, heavy: DataFrame, key: str, pick: Column) -> DataFrame:
    """Add ``salt``: ``pick`` on the rows of a heavy key, 0 elsewhere."""
    known = heavy.select(F.col("id").alias("_heavy"), F.col("slices").alias("_slices"))
    marked = df.join(F.broadcast(known), df[key] == known["_heavy"], "left")
    salt = F.coalesce(pick, F.lit(0)).cast("int").alias("salt")
    return marked.select(*[df[c] for c in df.columns], salt)


def _step(links: _Links, state: DataFrame, factor: float = 1.0) -> DataFrame:
    """One walk step: ``factor`` times the value that arrives at each node, ``(id, value)``.

    Nodes that receive nothing are left out. The state is shuffled to the edges, the partial sums
    are shuffled to their destinations; the edges stay where they are.
    """
    senders = state.select(F.col("id").alias("_id"), "value")
    match = links.edges["src"] == senders["_id"]
    if links.heavy is not None:
        known = links.heavy.select(F.col("id").alias("_heavy"), "slices")
        copies = F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)
        senders = senders.join(F.broadcast(known), senders["_id"] == known["_heavy"], "left").select(
            "_id", "value", F.explode(copies).alias("_salt")
        )
        match = (links.edges["src"] == senders["_id"]) & (links.edges["salt"] == senders["_salt"])
    sent = F.sum(F.col("value") * F.col("p")) * F.lit(factor)
    return links.edges.join(senders, match).groupBy(F.col("dst").alias("id")).agg(sent.alias("value"))


def _place(links: _Links) -> _Links:
    """Partition and sort the edges by their source (and salt) once, for all iterations."""
    partitions = int(links.edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["src"] if links.heavy is None else ["src", "salt"]
    placed = links.edges.select("src", "salt", "dst", "p").repartition(partitions, *keys)
    placed = placed.sortWithinPartitions(*keys)
    return _Links(placed.persist(StorageLevel.MEMORY_AND_DISK), links.heavy)


def _hold(edges: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The edges kept in memory, and what to release afterwards: nothing the caller had cached."""
    level = edges.storageLevel
    if level.useMemory or level.useDisk:
        return edges, []
    held = edges.persist(StorageLevel.MEMORY_AND_DISK)
    return held, [held]


def pagerank(
    edges: DataFrame,
    alpha: float = 0.15,
    iterations: int = 10,
    weighted: bool = True,
    normalise: bool = True,
    edges_per_task: int = ROWS_PER_TASK,
    cut_every: int = 2,
) -> DataFrame:
    """PageRank with teleportation ``alpha`` and redistribution of dangling mass.

    ``new = alpha / N + (1 - alpha) * (m / N + inflow)`` where ``m`` is the mass on dangling
    nodes before the step. Multiplicity counts through ``weight`` unless ``weighted`` is off;
    ``normalise=False`` scales the result by N, as graph libraries report it.

    Teleportation and dangling mass add the same amount to every node, and a step is linear. So
    the rank after T steps is ``sum_k c_k * v_k`` with ``v_0 = 1`` and ``v_k`` the k-step walk of
    ``v_0``. The walks need no global figure between the steps; the coefficients follow at the
    end from the dangling sums of all ``v_k``, which is one aggregate row. Lineage is cut every
    ``cut_every`` steps by a checkpoint in the shared folder.
    """
    table = _walks(edges, alpha, iterations, weighted, edges_per_task, cut_every)
    sums = table.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.when(~F.col("has_links"), F.col(f"v{k}"))).alias(f"v{k}") for k in range(iterations + 1)],
    ).first()
    n = sums["n"]
    coefficients = [1.0 / n if n else 0.0]
    for _ in range(iterations):
        mass = sum(c * (sums[f"v{k}"] or 0.0) for k, c in enumerate(coefficients))
        coefficients = [(alpha + (1 - alpha) * mass) / n if n else 0.0, *coefficients]
    rank = F.lit(0.0)
    for k, c in enumerate(coefficients):
        rank = rank + F.col(f"v{k}") * F.lit(c)
    return table.select("id", (rank * F.lit(1.0 if normalise else float(n))).alias("pagerank"))


def pagerank_by(
    edges: DataFrame,
    group: str,
    alpha: float = 0.15,
    iterations: int = 10,
    weighted: bool = True,
    edges_per_task: int = ROWS_PER_TASK,
    cut_every: int = 2,
    edges_per_graph: int = EDGES_PER_GRAPH,
) -> DataFrame:
    """``(group, id, pagerank)``: the ranks of many graphs at once, one for each value of ``group``
    (edges ``group, src, dst, weight``), each as :func:`pagerank` gives it for its graph alone.

    The edges of every graph are counted first. Graphs of at most ``edges_per_graph`` edges are
    iterated in one task each, so that all steps cost one shuffle of the edges; larger ones
    walk together step by step (:func:`_walks_by`). Equal but for rounding.
    """
    held, own = _hold(edges)
    sizes = held.groupBy(F.col(group).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    # at most edges / edges_per_graph rows
    large = cut_lineage(sizes.filter(F.col("n") > edges_per_graph).select("g"))
    if large.isEmpty():
        ranks = _ranks_in_tasks(held, group, alpha, iterations, weighted)
    else:
        match = held[group].eqNullSafe(large["g"])
        small = held.join(F.broadcast(large), match, "left_anti")
        walked = _walks_by(
            held.join(F.broadcast(large), match, "left_semi"), group, alpha, iterations, weighted, edges_per_task, cut_every
        )
        ranks = _ranks_in_tasks(small, group, alpha, iterations, weighted).unionByName(walked)
    ranks = cut_lineage(ranks)
    for frame in own:
        frame.unpersist()
    return ranks


def _ranks_in_tasks(edges: DataFrame, group: str, alpha: float, iterations: int, weighted: bool) -> DataFrame:
    """The ranks of graphs whose edges fit a task, each graph a sparse iteration over arrays."""

    def walk(table: pa.Table) -> pa.Table:
        m = table.num_rows
        ends = pa.chunked_array(table["src"].chunks + table["dst"].chunks).combine_chunks()
        ends = ends.dictionary_encode(null_encoding="encode")
        codes, n = ends.indices.to_numpy(), len(ends.dictionary)
        src, dst = codes[:m], codes[m:]
        weight = np.nan_to_num(table["weight"].cast(pa.float64()).to_numpy()) if weighted else np.ones(m)
        degree = np.bincount(src, weight, n)
        share = np.divide(weight, degree[src], out=np.zeros(m), where=degree[src] > 0)
        dangling = np.bincount(src, minlength=n) == 0
        rank = np.full(n, 1.0 / n)
        for _ in range(iterations):
            inflow = np.bincount(dst, rank[src] * share, n)
            rank = alpha / n + (1 - alpha) * (rank[dangling].sum() / n + inflow)
        name = pa.repeat(table[group][0], n)
        return pa.table({group: name, "id": ends.dictionary, "pagerank": pa.array(rank)})

    kinds = edges.select(group, F.col("src").alias("id"), F.lit(0.0).alias("pagerank")).schema
    return edges.select(group, "src", "dst", "weight").groupBy(group).applyInArrow(walk, kinds)


def _walks_by(
    edges: DataFrame, group: str, alpha: float, iterations: int, weighted: bool, edges_per_task: int, cut_every: int
) -> DataFrame:
    """The ranks of graphs of any size.

    Nodes are named by (group, node), so that all graphs walk together and a step is one join and
    one sum whatever their number. Number of nodes, dangling mass and the coefficients that follow
    from them belong to each graph; they are one row a graph and never leave the executors.
    """
    named = edges.select(
        *[F.struct(F.col(group).alias("g"), F.col(end).alias("v")).alias(end) for end in ("src", "dst")], "weight"
    )
    table = _walks(named, alpha, iterations, weighted, edges_per_task, cut_every)
    walks = F.array(*[F.col(f"v{k}") for k in range(iterations + 1)])
    sums = table.groupBy(F.col("id.g").alias("g")).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.array(
            *[F.coalesce(F.sum(F.when(~F.col("has_links"), F.col(f"v{k}"))), F.lit(0.0)) for k in range(iterations + 1)]
        ).alias("dangling"),
    )

    def earlier(known: Column) -> Column:
        """The coefficients of one step less, with that of the newest walk in front."""
        mass = F.aggregate(
            F.zip_with(known, F.slice("dangling", 1, F.size(known)), lambda c, d: c * d), F.lit(0.0), lambda a, x: a + x
        )
        return F.concat(F.array((F.lit(alpha) + F.lit(1 - alpha) * mass) / F.col("n")), known)

    steps = F.sequence(F.lit(1), F.lit(iterations)) if iterations else F.array().cast("array<int>")
    found = sums.select("g", F.aggregate(steps, F.array(F.lit(1.0) / F.col("n")), lambda known, _: earlier(known)).alias("c"))
    rank = F.aggregate(F.zip_with(walks, F.col("c"), lambda v, c: v * c), F.lit(0.0), lambda a, x: a + x)
    return table.join(found, F.col("id.g").eqNullSafe(F.col("g"))).select(
        F.col("g").alias(group), F.col("id.v").alias("id"), rank.alias("pagerank")
    )


def _walks(
    edges: DataFrame, alpha: float, iterations: int, weighted: bool, edges_per_task: int, cut_every: int
) -> DataFrame:
    """``id, has_links, v0 .. vT``: the walks of :func:`pagerank` from every node, written once."""
    held, own = _hold(edges)
    links = _place(_prepare(held, edges_per_task, weighted))
    flags = _nodes_with_links(held)
    walks = [cut_lineage(flags.select("id", "has_links", F.lit(1.0).alias("value")))]
    for k in range(1, iterations + 1):
        walk = _step(links, walks[-1], 1 - alpha)
        cut = k % cut_every == 0 and k < iterations
        walks.append(cut_lineage(walk) if cut else walk.persist(StorageLevel.MEMORY_AND_DISK))

    tagged = walks[0].select("id", "has_links", F.lit(0).alias("k"), "value")
    for k, walk in enumerate(walks[1:], start=1):
        part = walk.select("id", F.lit(None).cast("boolean").alias("has_links"), F.lit(k).alias("k"), "value")
        tagged = tagged.unionByName(part)
    table = cut_lineage(
        tagged.groupBy("id").agg(
            F.max("has_links").alias("has_links"),
            *[F.sum(F.when(F.col("k") == k, F.col("value")).otherwise(0.0)).alias(f"v{k}") for k in range(iterations + 1)],
        )
    )
    for frame in (*walks[1:], links.edges, *own):
        frame.unpersist()
    return table


def total_mass(ranks: DataFrame) -> DataFrame:
    """Sum of all ranks (1 when mass is conserved) and the number of nodes."""
    return ranks.agg(F.sum("pagerank").alias("total_mass"), F.count(F.lit(1)).alias("nodes"))


def rank_slice(ranks: DataFrame, first: int, last: int) -> DataFrame:
    """Nodes ranked after ``first`` up to ``last`` by descending rank."""
    ordered = ranks.orderBy(F.desc("pagerank"), F.asc("id"))
    return ordered.limit(last).orderBy(F.desc("pagerank"), F.asc("id")).offset(first)


def steady_state(edges: DataFrame, steps: int, start=None, cut_every: int = 8) -> DataFrame:
    """Power iteration ``state ← state · P`` without teleportation: ``(id, probability)``.

    Starts on ``start`` (or spread evenly). Without dangling nodes the state stays a probability
    distribution; with them, mass leaks, which is what the damped form repairs.
    """
    held, own = _hold(edges)
    links = _place(_prepare(held, ROWS_PER_TASK))
    nodes = cut_lineage(nodes_of(held))
    first = F.lit(1.0 / nodes.count()) if start is None else (F.col("id") == F.lit(start)).cast("double")
    state = nodes.select("id", first.alias("value"))
    for step in range(1, steps + 1):
        state = _step(links, state)
        if step % cut_every == 0 or step == steps:
            state = cut_lineage(state)
    for frame in (links.edges, *own):
        frame.unpersist()
    return nodes.join(state, "id", "left").select(
        "id", F.coalesce("value", F.lit(0.0)).alias("probability")
    )


def ranks_with_links(edges: DataFrame, ranks: DataFrame, rank: str = "rank") -> DataFrame:
    """Every node with its rank and the number and weight of its out-links (0 when dangling)."""
    degree = edges.groupBy(F.col("src").alias("_id")).agg(
        F.count(F.lit(1)).alias("neighbours"), F.sum("weight").alias("links")
    )
    return ranks.join(degree, ranks["id"] == degree["_id"], "left").select(
        "id",
        rank,
        F.coalesce("neighbours", F.lit(0)).alias("neighbours"),
        F.coalesce("links", F.lit(0)).alias("links"),
    )
