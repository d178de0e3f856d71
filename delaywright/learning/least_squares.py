"""Exact linear regression from mergeable moments.

Rows are read once: counts, means and co-moments of the features and the target, for each segment
of rows that is asked for. Moments of neighbouring segments add up to those of any span of them,
and a span's regression (plain, ridge or elastic net) and its error on another span follow from
the two spans' moments alone. What reaches the driver is one row a segment, with the square of
the number of features in it.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Moments:
    """``n`` rows, their ``mean`` and the sums ``cross`` of products of deviations from it; the last
    variable is the target."""

    n: int
    mean: np.ndarray
    cross: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        apart = other.mean - self.mean
        mean = self.mean + apart * (other.n / n)
        return Moments(n, mean, self.cross + other.cross + np.outer(apart, apart) * (self.n * other.n / n))


def moments(df: DataFrame, features: list[str], target: str, segment: Column | None = None) -> dict[int, Moments]:
    """Moments of every segment (an integer column; one segment 0 without it), in one aggregation.

    Rows with a null or NaN in a feature or the target do not count; a segment without rows is
    missing from the result."""
    names = [*features, target]
    values = df.select(
        (F.lit(0) if segment is None else segment).cast("int").alias("_segment"),
        *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"v{i}") for i, c in enumerate(names)],
    ).dropna()
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    # These aggregates are summed up in every task around running means: no large sums cancel.
    found = values.groupBy("_segment").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f"v{i}").alias(f"m{i}") for i in range(len(names))],
        *[F.covar_pop(f"v{i}", f"v{j}").alias(f"c{i}_{j}") for i, j in pairs],
    )
    result = {}
    for r in found.collect():
        cross = np.zeros((len(names), len(names)))
        for i, j in pairs:
            cross[i, j] = cross[j, i] = r[f"c{i}_{j}"] * r["n"]
        result[r["_segment"]] = Moments(r["n"], np.array([r[f"m{i}"] for i in range(len(names))]), cross)
    return result


def span(segments: dict[int, Moments], first: int, last: int) -> Moments | None:
    """The moments of segments ``first`` to ``last`` together; None without rows."""
    total = None
    for i in range(first, last + 1):
        if i in segments:
            total = segments[i] if total is None else total + segments[i]
    return total


@dataclass(frozen=True)
class LinearFit:
    coefficients: np.ndarray
    intercept: float

    def prediction(self, features: list[str]) -> Column:
        """The model as a column expression."""
        out = F.lit(float(self.intercept))
        for name, weight in zip(features, self.coefficients.tolist(), strict=True):
            out = out + F.col(name).cast("double") * F.lit(weight)
        return out

    def squared_error(self, on: Moments) -> float:
        """Mean squared error over the rows behind ``on``."""
        weights = np.append(self.coefficients, -1.0)
        bias = float(weights @ on.mean) + self.intercept
        return float(weights @ on.cross @ weights) / on.n + bias * bias


def fit(data: Moments, ridge: float = 0.0, l1: float = 0.0, sweeps: int = 1000, tolerance: float = 1e-12) -> LinearFit:
    """The minimum of ``sum of squares / 2n + ridge / 2 * |w|^2 + l1 * |w|``; the intercept is free.

    Features that depend on the others get the solution of least norm. With ``l1`` the coefficients
    are found one by one in turn (coordinate descent) on the moments."""
    scaled = data.cross / data.n
    gram, right = scaled[:-1, :-1], scaled[:-1, -1]
    if l1 > 0:
        weights = np.zeros(len(right))
        for _ in range(sweeps):
            before = weights.copy()
            for i in range(len(right)):
                rest = right[i] - gram[i] @ weights + gram[i, i] * weights[i]
                size = gram[i, i] + ridge
                weights[i] = np.sign(rest) * max(abs(rest) - l1, 0.0) / size if size > 0 else 0.0
            if np.abs(weights - before).max(initial=0.0) <= tolerance * (1 + np.abs(weights).max(initial=0.0)):
                break
    else:
        weights = np.linalg.lstsq(gram + ridge * np.eye(len(right)), right, rcond=1e-12)[0]
    return LinearFit(weights, float(data.mean[-1] - weights @ data.mean[:-1]))


def fit_rows(df: DataFrame, model: LinearFit, features: list[str]) -> DataFrame:
    """``slot, name, value``: the intercept and one row for each feature."""
    found = [(0, "intercept", float(model.intercept))]
    found += [(i, n, float(w)) for i, (n, w) in enumerate(zip(features, model.coefficients, strict=True), 1)]
    return df.sparkSession.createDataFrame(found, "slot int, name string, value double")
