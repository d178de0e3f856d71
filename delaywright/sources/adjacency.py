"""Weighted adjacency text: one line per source, ``node <tab> {'dest': count, ...}``."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaywright.operators.skew import ROWS_PER_TASK, OrderedScan, Total
from delaywright.runtime import spool

EDGES_PER_LINE = 100_000
#: Links that one task sorts: half a million of them take some 230 MB.
LINKS_PER_TASK = 500_000


def neighbour_map(text: Column) -> Column:
    """Parse ``{'a': 1, 'b': 2}`` as a map; single quotes are accepted, nothing is evaluated."""
    return F.from_json(text, "map<string,bigint>", {"allowSingleQuotes": "true"})


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Text lines → ``(node, neighbours)`` with ``neighbours`` a map of destination to count."""
    parts = F.split(F.col(column), "\t", 2)
    return lines.select(
        parts.getItem(0).alias("node"), neighbour_map(parts.getItem(1)).alias("neighbours")
    )


def explode_edges(records: DataFrame) -> DataFrame:
    """``(node, neighbours)`` → one row per edge ``(src, dst, weight)``.

    Lines that repeat a source are summed, so a very long adjacency list may be split over lines.
    """
    return (
        records.select(F.col("node").alias("src"), F.explode("neighbours").alias("dst", "weight"))
        .groupBy("src", "dst")
        .agg(F.sum("weight").alias("weight"))
    )


def read_adjacency(spark: SparkSession, path: str, numeric_ids: bool = False) -> DataFrame:
    """Read adjacency text into an edge list; ``numeric_ids`` narrows ids to bigint."""
    edges = explode_edges(parse_lines(spark.read.text(path)))
    if not numeric_ids:
        return edges
    return edges.select(
        F.col("src").try_cast("bigint").alias("src"),
        F.col("dst").try_cast("bigint").alias("dst"),
        "weight",
    )


def adjacency_lines(edges: DataFrame, edges_per_line: int = EDGES_PER_LINE) -> DataFrame:
    """Edge list → text lines. A source with more edges than ``edges_per_line`` gets several lines.

    The number of lines of a source comes from its out-degree, and a hash of the destination
    picks the line, so no task gathers an unbounded list.
    """
    degree = edges.groupBy(F.col("src").alias("_src")).agg(F.count(F.lit(1)).alias("_n"))
    heavy = degree.filter(F.col("_n") > edges_per_line).select(
        "_src", F.ceil(F.col("_n") / edges_per_line).cast("int").alias("_parts")
    )
    part = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("_parts")), F.lit(0))
    # at most edges / edges_per_line sources are heavy
    placed = edges.join(F.broadcast(heavy), edges["src"] == heavy["_src"], "left").withColumn("_part", part)
    entry = F.concat(F.lit("'"), F.col("dst").cast("string"), F.lit("': "), F.col("weight").cast("string"))
    listed = placed.groupBy("src", "_part").agg(
        F.array_join(F.sort_array(F.collect_list(entry)), ", ").alias("body")
    )
    return listed.select(
        F.concat(F.col("src").cast("string"), F.lit("\t{"), F.col("body"), F.lit("}")).alias("value")
    )


def write_adjacency(edges: DataFrame, path: str) -> str:
    adjacency_lines(edges).write.mode("overwrite").text(path)
    return path


def expand_multiplicity(
    records: DataFrame, per_part: int = 100_000, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``(node, neighbours)`` → ``(node, part, outlinks)``: each destination repeated by its count,
    destinations in order, ``per_part`` of them in a part (fewer in a node's last one).

    For exporting the text form; computations keep the weight instead. A node's links are cut by
    running sums of their weights, and one huge weight by itself, so neither a busy node nor a
    heavy link makes a long list. A node without links has one empty part.
    """
    links = explode_edges(records).filter("weight > 0")
    # Written once: they are measured and scanned, in as many tasks as their rows need.
    links = spool(links, "links")
    tasks = math.ceil(links.count() / LINKS_PER_TASK)
    scan = OrderedScan(["src"], ["dst"], rows_per_task)
    bounds = scan.measure(links)
    dealt = links if bounds is not None or tasks <= 1 else links.repartition(tasks, "src")
    ending = scan.run_measured(dealt, bounds, _ends=Total("weight"))
    start, end = F.col("_ends") - F.col("weight"), F.col("_ends")
    first, last = F.expr(f"(_ends - weight) div {per_part}"), F.expr(f"(_ends - 1) div {per_part}")
    parts = ending.select("src", "dst", start.alias("_starts"), end.alias("_ends"), F.explode(F.sequence(first, last)).alias("part"))
    inside = F.least("_ends", (F.col("part") + 1) * per_part) - F.greatest("_starts", F.col("part") * per_part)
    listed = parts.groupBy(F.col("src").alias("node"), "part").agg(
        F.array_sort(F.collect_list(F.struct("_starts", "dst", inside.cast("int").alias("n")))).alias("links")
    )
    repeated = F.flatten(F.transform("links", lambda x: F.array_repeat(x["dst"].cast("string"), x["n"])))
    lists = listed.select("node", "part", F.array_join(repeated, ",").alias("outlinks"))
    return records.select("node").distinct().join(lists, "node", "left").select(
        "node", F.coalesce("part", F.lit(0)).cast("bigint").alias("part"), F.coalesce("outlinks", F.lit("")).alias("outlinks")
    )
