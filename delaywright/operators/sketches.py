"""Approximate distinct counts from stored sketches that can be united later.

A sketch of 2 ** ``bits`` registers is kept for each group (a day, say); the count of any union of
groups follows from the sketches without reading the rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 14


def sketch_by(df: DataFrame, keys: list[str], column: str, bits: int = BITS) -> DataFrame:
    """``keys, sketch``: one mergeable sketch of the distinct values of ``column`` in each group;
    nulls do not count. Partial sketches are merged, so a busy group costs no more than a small one."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(column), bits).alias("sketch"))


def estimate(sketched: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, estimate``: distinct values of the united sketches of each (coarser) group."""
    return sketched.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def relative_error(bits: int = BITS, deviations: float = 5.0) -> float:
    """A bound on the relative error that holds but for ``deviations`` standard errors."""
    return deviations * 1.04 / 2 ** (bits / 2)
