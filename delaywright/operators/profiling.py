"""Column profiles: missing values, quartiles, outliers, histograms, scatter bins, samples.

Each profile is one aggregation over the table plus a reshape of the single result row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaywright.functions.expressions import safe_ratio
from delaywright.operators.selection import exact_quantiles


def column_rows(wide: DataFrame, fields: dict[str, dict[str, Column]]) -> DataFrame:
    """One-row frame → one row per profiled column: ``fields[column][name]`` gives the values."""
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[v.alias(n) for n, v in values.items()])
            for c, values in fields.items()
        ]
    )
    return wide.select(F.inline(entries))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, nulls, missing_pct)`` of every column in one pass."""
    columns = list(columns or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_n_{i}") for i, c in enumerate(columns)],
    )
    return column_rows(
        wide,
        {
            c: {
                "nulls": F.col(f"_n_{i}"),
                "missing_pct": safe_ratio(F.col(f"_n_{i}") * 100, F.col("_rows")),
            }
            for i, c in enumerate(columns)
        },
    )


def prune_sparse(df: DataFrame, max_missing_pct: float = 40.0) -> DataFrame:
    """Drop columns with a larger share of missing values (the profile decides the projection)."""
    kept = {
        r["column"] for r in null_profile(df).filter(F.col("missing_pct") <= max_missing_pct).collect()
    }
    return df.select(*[c for c in df.columns if c in kept])


def quartile_points(
    df: DataFrame, columns: Sequence[str], exact: bool = True, relative_error: float = 0.05
) -> dict[str, list[float]]:
    """Quartiles per column: exact, or with the given rank error from a sketch."""
    columns = list(columns)
    if exact:
        return exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    found = df.approxQuantile(columns, [0.25, 0.5, 0.75], relative_error)
    return dict(zip(columns, found))


def quartile_shares(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Share of all rows in the first three quartile buckets of each column."""
    points = {c: p for c, p in quartile_points(df, columns, exact).items() if p and p[0] is not None}
    rows = F.count(F.lit(1))
    aggregates = []
    for c, (q1, q2, q3) in points.items():
        value = F.col(c)
        aggregates += [
            safe_ratio(F.count_if(value <= q1), rows).alias(f"{c}_q1"),
            safe_ratio(F.count_if((value > q1) & (value <= q2)), rows).alias(f"{c}_q2"),
            safe_ratio(F.count_if((value > q2) & (value <= q3)), rows).alias(f"{c}_q3"),
        ]
    wide = df.agg(*aggregates)
    return column_rows(
        wide, {c: {q: F.col(f"{c}_{q}") for q in ("q1", "q2", "q3")} for c in points}
    )


def iqr_fences(
    df: DataFrame, columns: Sequence[str], exact: bool = True, factor: float = 1.5
) -> dict[str, tuple[float, float]]:
    fences = {}
    for c, points in quartile_points(df, columns, exact).items():
        if points and points[0] is not None:
            q1, q3 = points[0], points[2]
            fences[c] = (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return fences


def iqr_bounds(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """``(column, lower_bound, upper_bound)``, with how many rows lie between the bounds."""
    fences = iqr_fences(df, columns, exact)
    wide = df.agg(
        *[F.count_if(F.col(c).between(lo, hi)).alias(f"{c}_in") for c, (lo, hi) in fences.items()]
    )
    return column_rows(
        wide,
        {
            c: {"lower_bound": F.lit(lo), "upper_bound": F.lit(hi), "rows_inside": F.col(f"{c}_in")}
            for c, (lo, hi) in fences.items()
        },
    )


def with_outlier_flags(df: DataFrame, fences: dict[str, tuple[float, float]]) -> DataFrame:
    """Boolean columns ``<column>_lower_outlier`` and ``<column>_upper_outlier``."""
    flags = []
    for c, (low, high) in fences.items():
        flags.append((F.col(c) < low).alias(f"{c}_lower_outlier"))
        flags.append((F.col(c) > high).alias(f"{c}_upper_outlier"))
    return df.select("*", *flags)


def outlier_pct(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Percentage of all rows outside the fences of each column."""
    fences = iqr_fences(df, columns, exact)
    rows = F.count(F.lit(1))
    wide = df.agg(
        *[
            safe_ratio(F.count_if((F.col(c) < lo) | (F.col(c) > hi)) * 100, rows).alias(f"{c}_p")
            for c, (lo, hi) in fences.items()
        ]
    )
    return column_rows(wide, {c: {"outlier_pct": F.col(f"{c}_p")} for c in fences})


def five_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Box-plot summary: minimum, quartiles, maximum, and the number of values."""
    points = exact_quantiles(df, list(columns), [0.0, 0.25, 0.5, 0.75, 1.0])
    names = ("min", "q1", "median", "q3", "max")
    wide = df.agg(*[F.count(c).alias(f"{c}_n") for c in columns])
    return column_rows(
        wide,
        {
            c: {
                **{n: F.lit(v).cast("double") for n, v in zip(names, points[c])},
                "n": F.col(f"{c}_n"),
            }
            for c in columns
        },
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum; the maximum falls into the last bin.

    ``(bin, low, high, n)`` for the bins that have rows; ``bin`` starts at 0.
    """
    edge = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    low, high = edge["lo"], edge["hi"]
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, n bigint")
    width = (high - low) / bins or 1.0
    at = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counted = (
        df.filter(F.col(column).isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        "n",
    )


def binned_scatter(df: DataFrame, x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """Scatter plot data as counts per grid cell, so its size does not grow with the rows."""
    return (
        df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(
            F.floor(F.col(x) / x_width).alias("x_bin"), F.floor(F.col(y) / y_width).alias("y_bin")
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def clip_effect(raw: DataFrame, clipped: DataFrame, column: str) -> DataFrame:
    """Mean and standard deviation before and after clipping, one row each."""
    parts = []
    for stage, df in (("before", raw), ("after", clipped)):
        parts.append(
            df.agg(
                F.avg(column).alias("mean"),
                F.stddev_samp(column).alias("stddev"),
                F.max(column).alias("max"),
            ).select(F.lit(stage).alias("stage"), "mean", "stddev", "max")
        )
    return parts[0].unionByName(parts[1])


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def keyed_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Repeatable sample by the md5 of the key: the same ids are drawn wherever the rows lie, and
    any system with md5 can draw them again."""
    bound = f"{min(0xFFFFFFFF, int(fraction * (1 << 32))):08x}"
    return df.filter(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8) < bound)


def fixed_size_sample(df: DataFrame, n: int, seed: int, key: Sequence[str]) -> DataFrame:
    """``n`` rows without replacement: the smallest md5 of seed and key (a distributed top-k)."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]).cast("binary"))
    return df.withColumn("_h", order).orderBy("_h", *key).limit(n).drop("_h")
