"""Prefix sums over sorted distinct values, average ranks, rank correlation, ROC area.

All of them start from a frequency table (one row per distinct value), so a value that fills a
third of the table costs one row. The frequency table is cut into value ranges, each range is
accumulated on its own and the range totals are added on top: no single task sees all values.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaywright.operators.skew import ROWS_PER_TASK, attach
from delaywright.runtime import spool

ROWS_PER_RANGE = 1_000_000
BROADCAST_VALUES = 1_000_000


def prefix_sums(
    table: DataFrame, value: str, measures: list[str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Add ``before_<measure>``: its total over all smaller values of ``value``.

    ``table`` has one row per distinct non-null numeric ``value``. It is written to the shared
    folder once, because the ranges, their totals and the final join all read it.
    """
    table = spool(table, "frequencies")
    ranges = max(1, math.ceil(table.count() / rows_per_range))
    inside = [F.coalesce(F.sum(m).over(_earlier(value, ranges)), F.lit(0)) for m in measures]
    if ranges == 1:
        return table.select("*", *[c.alias(f"before_{m}") for c, m in zip(inside, measures)])
    ranged = _with_range(table, value, ranges)
    local = ranged.select("*", *[c.alias(f"_in_{m}") for c, m in zip(inside, measures)])
    totals = ranged.groupBy(F.col("_range").alias("_r")).agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    # one row per million distinct values: one task and a broadcast are fine
    by_range = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_r", *[F.coalesce(F.sum(f"_t_{m}").over(by_range), F.lit(0)).alias(f"_off_{m}") for m in measures]
    )
    return local.join(F.broadcast(offsets), local["_range"] == offsets["_r"]).select(
        *[local[c] for c in table.columns],
        *[(F.col(f"_in_{m}") + F.col(f"_off_{m}")).alias(f"before_{m}") for m in measures],
    )


def _earlier(value: str, ranges: int):
    """All smaller values; of the same range if there are several."""
    window = Window.partitionBy("_range") if ranges > 1 else Window.partitionBy()
    return window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)


def _with_range(table: DataFrame, value: str, ranges: int) -> DataFrame:
    """Number the value ranges; the cut points come from a quantile sketch of the table."""
    keyed = table.withColumn("_as_double", F.col(value).cast("double"))
    probabilities = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(keyed.approxQuantile("_as_double", probabilities, 0.25 / ranges)))
    splitter = Bucketizer(
        splits=[-math.inf, *cuts, math.inf], inputCol="_as_double", outputCol="_range"
    )
    return splitter.transform(keyed).drop("_as_double")


@dataclass(frozen=True)
class Ranking:
    """Ranks of several columns: ``table`` has ``t, v, n, centred``, one row for each column (by its
    number ``t``) and distinct value ``v``; ``n`` rows have it, and ``centred`` is its average rank
    less the column's mean rank."""

    table: DataFrame
    values: int


def rank_columns(rows: DataFrame, columns: list[Column], rows_per_range: int = ROWS_PER_RANGE) -> Ranking:
    """Rank all ``columns`` (numeric expressions over ``rows``, compared as doubles; nulls have no
    rank) in one pass.

    The values go into long form, counted before the only shuffle of them. Ranges of (column,
    value) are summed up on their own, and the totals of the ranges are added on top.
    """
    entries = [F.struct(F.lit(t).alias("t"), c.cast("double").alias("v")) for t, c in enumerate(columns)]
    counted = rows.select(F.inline(F.array(*entries))).filter("v IS NOT NULL").groupBy("t", "v").agg(F.count(F.lit(1)).alias("n"))
    table = spool(counted, "frequencies")
    values = table.count()
    ranges = max(1, math.ceil(values / rows_per_range))
    if ranges > 1:
        table = spool(table.repartitionByRange(ranges, "t", "v").withColumn("_range", F.spark_partition_id()), "ranges")
    else:
        table = table.withColumn("_range", F.lit(0))
    earlier = Window.partitionBy("t", "_range").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    local = table.withColumn("_in", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    # One row for each column and range: a million values each, so these can be broadcast.
    totals = table.groupBy(F.col("t").alias("_t"), F.col("_range").alias("_r")).agg(F.sum("n").alias("_n"))
    before = Window.partitionBy("_t").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_t",
        "_r",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy("_t")).alias("_all"),
    )
    placed = local.join(F.broadcast(offsets), (local["t"] == offsets["_t"]) & (local["_range"] == offsets["_r"]))
    rank = F.col("_in") + F.col("_off") + (F.col("n") + 1) / 2.0
    return Ranking(placed.select("t", "v", "n", (rank - (F.col("_all") + 1) / 2.0).alias("centred")), values)


def attach_ranks(
    rows: DataFrame,
    columns: list[Column],
    ranking: Ranking,
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_values: int | None = None,
) -> DataFrame:
    """One column ``r0, r1, …`` with the centred rank for each of ``columns``; null values have none.

    The columns of few distinct values are broadcast, up to ``broadcast_values`` of them in all. The
    others are joined in long form, once for all of them, and carry the ranks found so far; values
    that own many rows are spread over salts."""
    limit = BROADCAST_VALUES if broadcast_values is None else broadcast_values
    table = spool(ranking.table, "ranks")
    sizes = {r["t"]: r["count"] for r in table.groupBy("t").count().collect()}
    few, held = [], 0
    for t in sorted(range(len(columns)), key=lambda t: sizes.get(t, 0)):
        held += sizes.get(t, 0)
        if held <= limit:
            few.append(t)
    many = [t for t in range(len(columns)) if t not in few]
    narrow = rows.select(*[c.cast("double").alias(f"v{t}") for t, c in enumerate(columns)])
    if many:
        # Written once: the rows' numbers must be the same whenever a part is computed again.
        narrow = spool(narrow.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    out = narrow
    for t in few:
        own = table.filter(F.col("t") == t).select(F.col("v").alias(f"_v{t}"), F.col("centred").alias(f"r{t}"))
        out = out.join(F.broadcast(own), out[f"v{t}"] == own[f"_v{t}"], "left").drop(f"_v{t}")
    found = [f"r{t}" for t in range(len(columns))]
    if not many:
        return out.select(*found)
    carried = [f"r{t}" for t in few]
    entries = [F.struct(F.lit(t).alias("t"), F.col(f"v{t}").alias("v")) for t in many]
    long = out.select("_row", *carried, F.inline(F.array(*entries))).filter("v IS NOT NULL")
    large = table.filter(F.col("t").isin(many))
    ranked = attach(long, large, ["t", "v"], "n", ["_row"], rows_per_task).select("_row", "t", "centred", *carried)
    if few:
        # Rows without any value in the large columns.
        empty = F.coalesce(*[F.col(f"v{t}") for t in many]).isNull()
        ranked = ranked.unionByName(out.filter(empty).select("_row", *carried), allowMissingColumns=True)
    return ranked.groupBy("_row").agg(
        *[F.max(F.when(F.col("t") == t, F.col("centred"))).alias(f"r{t}") for t in many],
        *[F.max(c).alias(c) for c in carried],
    ).select(*found)


def spearman_pairs(
    df: DataFrame,
    columns: list[str],
    rows_per_task: int = ROWS_PER_TASK,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Rank correlation of every column pair: ``(col_a, col_b, rho)``, pairwise complete.

    Columns without nulls share one ranking. A pair that involves a column with nulls is ranked
    on the rows where both are present. All these rankings are made in one pass and joined back
    together, whatever the number of columns. Ranks are centred on their known mean, so the sums
    do not cancel.
    """
    pairs = list(combinations(columns, 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, rho double")
    rows = df.select(*columns)
    holes = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    ranked: dict[str | tuple[str, str], Column] = {c: F.col(c) for c in columns if not holes[c]}
    sides = {}
    for a, b in pairs:
        if holes[a] or holes[b]:
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            ranked |= {(a, a, b): F.when(both, F.col(a)), (b, a, b): F.when(both, F.col(b))}
            sides[a, b] = ((a, a, b), (b, a, b))
        else:
            sides[a, b] = (a, b)
    names, expressions = list(ranked), list(ranked.values())
    attached = attach_ranks(rows, expressions, rank_columns(rows, expressions, rows_per_range), rows_per_task)

    def correlation(a, b) -> Column:
        x, y = F.col(f"r{names.index(a)}"), F.col(f"r{names.index(b)}")
        return F.try_divide(F.sum(x * y), F.sqrt(F.sum(x * x)) * F.sqrt(F.sum(y * y)))

    # A column's own sum of squares counts the rows of its ranking only.
    wide = attached.agg(*[correlation(*sides[p]).alias(f"p{i}") for i, p in enumerate(pairs)])
    return pair_rows(wide, pairs, "rho")


def pair_rows(wide: DataFrame, pairs: list[tuple[str, str]], value: str) -> DataFrame:
    """Turn the one-row frame ``p0, p1, …`` into ``(col_a, col_b, value)`` rows."""
    entries = F.array(
        *[
            F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"p{i}").alias(value))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return wide.select(F.inline(entries))


def pearson_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair in one aggregation; nulls are dropped per pair."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(
        *[
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return pair_rows(wide, pairs, "r")


def roc_area(df: DataFrame, score: str, label: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Area under the ROC curve by the rank-sum formula; tied scores count one half."""
    by_score = (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(score)
        .agg(
            F.count_if(F.col(label) == 1).alias("pos"),
            F.count_if(F.col(label) != 1).alias("neg"),
        )
    )
    placed = prefix_sums(by_score, score, ["neg"], rows_per_range)
    wins = F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2.0))
    return placed.agg(
        F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )
