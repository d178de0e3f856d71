"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaywright.runtime import cut_lineage


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, component`` for every node of ``edges``: the smallest node it is connected with.

    Ids are long. Each round replaces edges by stars around the smallest neighbour: every larger
    neighbour of a node is linked to the node's smallest neighbour (large star), then the smaller
    ones are (small star). Stars are computed with aggregates and joins, so a hub's neighbours are
    spread over tasks; the number of rounds grows with the logarithm of the longest path. Null ids
    and loops are left out; an empty table gives no rows.
    """
    pairs = edges.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v"))
    pairs = cut_lineage(
        pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(smallest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"), F.col("u").alias("w"))
        linked = small.select("u", "v").unionByName(small.select(F.col("w").alias("u"), "v"))
        pairs = cut_lineage(linked.filter("u <> v").distinct())
        sums = pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
        if sums == before or not sums[0]:
            break
        before = sums
    nodes = pairs.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = nodes.select(F.col("component").alias("node"), F.col("component")).distinct()
    return nodes.unionByName(roots)
