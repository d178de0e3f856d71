"""Grouped summaries, shares, ratios, pivots and confusion counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaywright.functions.expressions import safe_ratio
from delaywright.operators.skew import ROWS_PER_TASK, attach


def count_by(df: DataFrame, *keys: str | Column, name: str = "flights") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def averages_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"avg_{c}") for c in columns])


def summary_by(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum per group (nulls ignored)."""
    return df.groupBy(*keys).agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("stddev"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )


def ratio_by(df: DataFrame, keys: Sequence[str], flag: Column, name: str = "ratio") -> DataFrame:
    """Share of rows per group for which ``flag`` (0/1) is set."""
    hits, rows = F.sum(flag), F.count(F.lit(1))
    return df.groupBy(*keys).agg(
        hits.cast("bigint").alias("hits"), rows.alias("rows"), (hits / rows).alias(name)
    )


def share_within(
    df: DataFrame,
    group: Sequence[str],
    category: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Count per (group, category) and its percentage of the group.

    Counts are aggregated first; the group totals are summed from the counts, not from the rows.
    """
    counts = df.groupBy(*group, *category).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*group).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("_categories"))
    joined = attach(counts, totals, list(group), "_categories", list(category), rows_per_task)
    return joined.drop("_categories").withColumn("percentage", F.col("n") / F.col("total") * 100)


def daily_by_year(df: DataFrame, date: str, years: Sequence[int] | None = None) -> DataFrame:
    """Rows per calendar day of the year, one column per year.

    Daily totals are built first. Without ``years``, the years are those that occur in the totals
    (at most one column per year of the data); a year that is not listed is an error, not a loss.
    """
    daily = df.groupBy(F.to_date(date).alias("day")).agg(F.count(F.lit(1)).alias("n")).filter("day IS NOT NULL")
    daily = daily.withColumn("_year", F.year("day"))
    known = sorted(r["_year"] for r in daily.select("_year").distinct().collect())
    if years is not None and not set(known) <= set(years):
        raise ValueError(f"years outside the list: {sorted(set(known) - set(years))}")
    years = known if years is None else years
    return (
        daily.groupBy(F.date_format("day", "MM-dd").alias("month_day"))
        .pivot("_year", list(years))
        .agg(F.sum("n"))
        .select("month_day", *[F.coalesce(F.col(str(y)), F.lit(0)).alias(f"y{y}") for y in years])
    )


def daily_counts_by_year(df: DataFrame, date: str) -> DataFrame:
    """The rows of :func:`daily_by_year` with the years as one array ``counts`` in ascending order
    of the years that occur: the columns do not depend on the data."""
    wide = daily_by_year(df, date)
    years = sorted(c for c in wide.columns if c != "month_day")
    return wide.select("month_day", F.array(*[F.col(y) for y in years]).alias("counts"))


def confusion_counts(
    df: DataFrame, predicted: str, actual: str, by: Sequence[str] = ()
) -> DataFrame:
    """True/false positives and negatives in one pass, optionally per group."""
    p, a = F.col(predicted), F.col(actual)
    return df.groupBy(*by).agg(
        F.count_if((p == 1) & (a == 1)).alias("tp"),
        F.count_if((p == 1) & (a == 0)).alias("fp"),
        F.count_if((p == 0) & (a == 1)).alias("fn"),
        F.count_if((p == 0) & (a == 0)).alias("tn"),
    )


def with_prf(df: DataFrame, beta: float = 2.0) -> DataFrame:
    """Add precision, recall and F-beta to a frame with ``tp``, ``fp``, ``fn``; 0 when undefined."""
    b2 = beta * beta
    measured = df.select(
        "*",
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return measured.withColumn("fbeta", safe_ratio(p * r * (1 + b2), p * b2 + r))


def confusion_matrix(
    df: DataFrame, predicted: str, actual: str, classes: Sequence[int] | None = None
) -> DataFrame:
    """One row per actual class, one column ``predicted_<class>`` per predicted class, 0-filled.

    Without ``classes``, 0, 1 and every other class that is predicted get a column; a predicted
    class outside a given list is an error, not a loss. Rows without a prediction count as ``predicted_null`` if
    there are any.
    """
    counts = df.groupBy(F.col(actual).cast("int").alias("actual"), F.col(predicted).cast("int").alias("_p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    found = {r["_p"] for r in counts.select("_p").distinct().collect()}
    known = sorted(found - {None})
    if classes is not None and not set(known) <= set(classes):
        raise ValueError(f"predicted classes outside the list: {sorted(set(known) - set(classes))}")
    names = [str(c) for c in (sorted({0, 1, *known}) if classes is None else classes)] + ["null"] * (None in found)
    wide = counts.withColumn("_p", F.coalesce(F.col("_p").cast("string"), F.lit("null")))
    wide = wide.groupBy("actual").pivot("_p", names).agg(F.sum("n"))
    return wide.select("actual", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(f"predicted_{c}") for c in names])


def calendar_averages(df: DataFrame, parts: Mapping[str, Column], value: str) -> DataFrame:
    """Average of ``value`` per day of month, day of week, month, hour … in a single pass.

    Rows are aggregated once on all parts together (at most days × hours groups); each part is
    then rolled up from those partial sums.
    """
    base = df.groupBy(*[c.cast("int").alias(n) for n, c in parts.items()]).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_n")
    )
    entries = F.array(
        *[F.struct(F.lit(n).alias("part"), F.col(n).alias("value")) for n in parts]
    )
    return (
        base.select("_sum", "_n", F.inline(entries))
        .groupBy("part", "value")
        .agg(F.try_divide(F.sum("_sum"), F.sum("_n")).alias("average"), F.sum("_n").alias("n"))
    )
