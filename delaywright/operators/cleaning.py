"""Projection, casting, filtering, de-duplication and clipping."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, NumericType, StringType, StructType

from delaywright.operators.selection import exact_quantiles

# Postal codes of the US states, the district and the territories.
US_STATES = (
    "AL",
    "AK",
    "AZ",
    "AR",
    "AS",
    "CA",
    "CO",
    "CT",
    "DE",
    "DC",
    "FL",
    "GA",
    "GU",
    "HI",
    "ID",
    "IL",
    "IN",
    "IA",
    "KS",
    "KY",
    "LA",
    "ME",
    "MD",
    "MA",
    "MI",
    "MN",
    "MS",
    "MO",
    "MT",
    "NE",
    "NV",
    "NH",
    "NJ",
    "NM",
    "NY",
    "NC",
    "ND",
    "MP",
    "OH",
    "OK",
    "OR",
    "PA",
    "PR",
    "RI",
    "SC",
    "SD",
    "TN",
    "TX",
    "UT",
    "VT",
    "VA",
    "VI",
    "WA",
    "WV",
    "WI",
    "WY",
)


def keep_known(df: DataFrame, allowed: Iterable[str]) -> DataFrame:
    """Project the allowed columns that exist, in the order of the allow-list.

    With a list of what is known two hours before departure this is the leakage guard.
    """
    present = set(df.columns)
    return df.select(*[c for c in allowed if c in present])


def cast_columns(df: DataFrame, types: Mapping[str, str | DataType] | StructType) -> DataFrame:
    """Cast the listed columns in one projection; text that does not parse becomes null.

    Whole numbers written with a decimal point (``-3.0``) are read as such, fractions are cut off.
    """
    if isinstance(types, StructType):
        types = {f.name: f.dataType for f in types.fields}
    return df.select(
        *[_narrowed(df, c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )


def _narrowed(df: DataFrame, column: str, target: str | DataType) -> Column:
    wanted = target if isinstance(target, DataType) else DataType.fromDDL(target)
    value = F.col(column)
    if isinstance(wanted, IntegralType) and isinstance(df.schema[column].dataType, StringType):
        return F.coalesce(value.try_cast(wanted), value.try_cast("double").try_cast(wanted))
    return value.try_cast(wanted)


def cast_dates(df: DataFrame, columns: Sequence[str], pattern: str = "yyyy-MM-dd") -> DataFrame:
    return df.select(
        *[F.try_to_date(F.col(c), pattern).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def with_known_target(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(target).isNotNull())


def within_country(
    df: DataFrame, origin: str, destination: str, allowed: Sequence[str] | DataFrame = US_STATES
) -> DataFrame:
    """Rows whose both ends are in ``allowed``: a list, or a one-column table of any size."""
    if isinstance(allowed, DataFrame):
        name = allowed.columns[0]
        for i, end in enumerate((origin, destination)):
            codes = allowed.select(F.col(name).alias(f"_code{i}")).distinct()
            df = df.join(codes, F.col(end) == F.col(f"_code{i}"), "left_semi")
        return df
    return df.filter(F.col(origin).isin(list(allowed)) & F.col(destination).isin(list(allowed)))


def below(df: DataFrame, column: str, bound: float) -> DataFrame:
    """Keep rows whose value, read as a number, is below ``bound``; unreadable values go."""
    return df.filter(F.col(column).try_cast("double") < bound)


def since(df: DataFrame, date: str, start: dt.date | dt.datetime | str) -> DataFrame:
    """Lower date bound, kept free of expressions on the column so that the scan can prune."""
    return df.filter(F.col(date) >= F.lit(start))


def trailing_days(df: DataFrame, date: str, days: int = 730) -> DataFrame:
    """Rows of the last ``days`` days relative to the latest date in the data.

    The bound is a scalar subquery; it is pushed into the scan once its value is known.
    """
    start = df.agg(F.date_sub(F.max(date), days).cast(df.schema[date].dataType)).scalar()
    return df.filter(F.col(date) >= start)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the smallest in ``order_by`` (then in all other columns).

    It is an aggregate, not a window: copies collapse before the shuffle, so a key with very many
    copies costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [*order_by, *[c for c in rest if c not in order_by]]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_kept"))
    return kept.select(*[F.col(c) if c in keys else F.col("_kept")[c].alias(c) for c in df.columns])


def clip_at_quantile(df: DataFrame, column: str, probability: float = 0.95) -> DataFrame:
    """Replace values above the exact quantile by the quantile; no row is dropped."""
    bound = exact_quantiles(df, [column], [probability])[column][0]
    if bound is None:
        return df
    clipped = F.when(F.col(column) > bound, F.lit(bound)).otherwise(F.col(column))
    return df.withColumn(column, clipped)


def tagged_union(parts: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Union by name with a constant column that tells where a row came from."""
    result = None
    for name, part in parts.items():
        labelled = part.withColumn(tag, F.lit(name))
        result = labelled if result is None else result.unionByName(labelled)
    return result


def keys_without_match(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of ``left`` that do not occur in ``right``."""
    keys = left.select(*on).distinct()
    return keys.join(right.select(*on).distinct(), list(on), "left_anti")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)
