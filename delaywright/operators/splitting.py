"""Chronological splits and folds without a global row number.

The rank of a row in (date, id) order is never materialised. A cut after row ``k`` is found from
the daily row counts (one row per calendar day) and, inside the one day it falls into, from the
exact k-th smallest id. The cut is then the predicate ``(date, id) <= (day, id_k)``, which costs
no shuffle and gives the same rows as ``row_number() over (order by date, id) <= k``.
"""

from __future__ import annotations

import bisect
import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from delaywright.operators.selection import order_statistics


@dataclass(frozen=True)
class Cut:
    """Boundary after the first ``position`` rows; ``date`` is None at the very ends."""

    position: int
    date: dt.date | None = None
    last_id: int | None = None
    at_end: bool = False

    def upto(self, date: str, row_id: str) -> Column:
        """True for the first ``position`` rows."""
        if self.date is None:
            return F.lit(self.at_end)
        day = F.lit(self.date)
        return (F.col(date) < day) | ((F.col(date) == day) & (F.col(row_id) <= F.lit(self.last_id)))


@dataclass(frozen=True)
class Fold:
    """1-based inclusive row ranges of one train/test pair."""

    number: int
    train_start: int
    train_end: int
    test_start: int
    test_end: int


def chronological_cuts(
    df: DataFrame, date: str, row_id: str, positions: Sequence[int] | Callable[[int], Sequence[int]]
) -> list[Cut]:
    """Cuts after the given row positions, or after those a function derives from the row count.

    Give it the narrow source frame, not a derived one: the cuts hold for every frame with the
    same dates and ids.
    """
    if not isinstance(df.schema[date].dataType, DateType):
        raise TypeError(f"{date} must be a date: the daily counts are held on the driver")
    daily = df.groupBy(date).agg(F.count(F.lit(1)).alias("n")).orderBy(date).collect()
    if daily and daily[0][0] is None:
        raise ValueError(f"{date} has nulls; filter them before a chronological split")
    ends = list(accumulate(r["n"] for r in daily))
    total = ends[-1] if ends else 0
    if callable(positions):
        positions = positions(total)
    cuts: dict[int, Cut] = {}
    open_days: dict[dt.date, list[tuple[int, int]]] = {}
    for k in sorted(set(positions)):
        if k <= 0:
            cuts[k] = Cut(k)
        elif k >= total:
            cuts[k] = Cut(k, at_end=True)
        else:
            i = bisect.bisect_left(ends, k)
            day_start = ends[i - 1] if i else 0
            open_days.setdefault(daily[i][0], []).append((k, k - day_start))
    if open_days:
        # ids of each boundary day side by side, so one pass serves all cuts
        days = list(open_days)
        ids = [F.when(F.col(date) == F.lit(day), F.col(row_id)).alias(f"_{i}") for i, day in enumerate(days)]
        sizes = {f"_{i}": r["n"] for i, day in enumerate(days) for r in daily if r[0] == day}
        wanted = [(f"_{i}", rank) for i, day in enumerate(days) for _, rank in open_days[day]]
        found = order_statistics(df.filter(F.col(date).isin(days)).select(*ids), wanted, sizes)
        targets = [(k, day) for day in days for k, _ in open_days[day]]
        for (k, day), last_id in zip(targets, found):
            cuts[k] = Cut(k, day, last_id)
    return [cuts[k] for k in positions]


def total_rows(df: DataFrame) -> int:
    return df.count()


def split_positions(total: int, train: float = 0.8, fit: float | None = None) -> list[int]:
    """Cut positions: the first 80 % for training, optionally its first 70 % for fitting."""
    end = int(total * train)
    return [end] if fit is None else [int(end * fit), end]


def label_parts(
    df: DataFrame, date: str, row_id: str, cuts: Sequence[Cut], names: Sequence[str], output: str = "part"
) -> DataFrame:
    """Name the parts between the cuts; one projection, no shuffle."""
    column = None
    for cut, name in zip(cuts, names):
        inside = cut.upto(date, row_id)
        column = F.when(inside, name) if column is None else column.when(inside, name)
    return df.withColumn(output, column.otherwise(names[-1]))


def split_train_test(df: DataFrame, date: str, row_id: str, train: float = 0.8) -> DataFrame:
    cuts = chronological_cuts(df, date, row_id, lambda total: split_positions(total, train))
    return label_parts(df, date, row_id, cuts, ["train", "test"])


def split_train_val_test(
    df: DataFrame, date: str, row_id: str, train: float = 0.8, fit: float = 0.7
) -> DataFrame:
    cuts = chronological_cuts(df, date, row_id, lambda total: split_positions(total, train, fit))
    return label_parts(df, date, row_id, cuts, ["train", "validation", "test"])


def training_with_validation_flag(parts: DataFrame) -> DataFrame:
    """Train and validation rows with the boolean column that drives early stopping."""
    return parts.filter(F.col("part").isin("train", "validation")).withColumn(
        "is_validation", F.col("part") == "validation"
    )


def split_report(parts: DataFrame, date: str) -> DataFrame:
    """Rows, percentage, first and last day of every part in one aggregation."""
    grouped = parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(date).alias("first_day"),
        F.max(date).alias("last_day"),
    )
    total = parts.agg(F.count(F.lit(1))).scalar()
    return grouped.withColumn("pct", F.col("rows") * 100.0 / total)


def sliding_folds(total: int, train_share: int = 3, test_share: int = 10) -> list[Fold]:
    """Sliding windows: train ``n // 3`` rows, test ``n // 10`` rows, step by the test size."""
    train, test = total // train_share, total // test_share
    if test == 0:
        return []
    count = (total - (train + test)) // test
    return [
        Fold(i + 1, i * test + 1, i * test + train, i * test + train + 1, i * test + train + test)
        for i in range(count)
    ]


def expanding_folds(total: int, train_share: int = 3, test_share: int = 10) -> list[Fold]:
    """The same test windows, but training always starts at the first row."""
    return [
        Fold(f.number, 1, f.train_end, f.test_start, f.test_end)
        for f in sliding_folds(total, train_share, test_share)
    ]


@dataclass(frozen=True)
class FoldPredicates:
    fold: Fold
    train: Column
    test: Column


def fold_predicates(df: DataFrame, date: str, row_id: str, folds: Sequence[Fold]) -> list[FoldPredicates]:
    positions = sorted({p for f in folds for p in (f.train_start - 1, f.train_end, f.test_end)})
    cuts = dict(zip(positions, chronological_cuts(df, date, row_id, positions)))

    def between(start: int, end: int) -> Column:
        return cuts[end].upto(date, row_id) & ~cuts[start - 1].upto(date, row_id)

    return [
        FoldPredicates(f, between(f.train_start, f.train_end), between(f.test_start, f.test_end))
        for f in folds
    ]


@dataclass(frozen=True)
class Segments:
    """Rows between neighbouring cuts of a set of folds, numbered from 0 by ``number``."""

    number: Column
    positions: list[int]

    def within(self, start: int, end: int) -> range:
        """The segments of rows ``start`` to ``end`` of a fold (1-based, inclusive)."""
        return range(self.positions.index(start - 1) + 1, self.positions.index(end) + 1)


def fold_segments(df: DataFrame, date: str, row_id: str, folds: Sequence[Fold]) -> Segments:
    """The segments that all windows of ``folds`` are put together from."""
    positions = sorted({p for f in folds for p in (f.train_start - 1, f.train_end, f.test_end)})
    number = F.lit(0)
    for cut in chronological_cuts(df, date, row_id, positions):
        number = number + (~cut.upto(date, row_id)).cast("int")
    return Segments(number, positions)


def hashed_folds(df: DataFrame, row_id: str, folds: int, output: str = "fold") -> DataFrame:
    """Number each row's fold, 0 to ``folds - 1``, by the md5 of its id: the same rows fall into the
    same fold wherever they lie, and any system with md5 can tell which."""
    digits = F.substring(F.md5(F.col(row_id).cast("string").cast("binary")), 1, 8)
    return df.withColumn(output, (F.conv(digits, 16, 10).cast("bigint") % folds).cast("int"))


def fold_report(df: DataFrame, date: str, row_id: str, folds: Sequence[Fold]) -> DataFrame:
    """Size and date range of the two windows of every fold.

    Rows are counted once per segment between neighbouring cuts; folds overlap, so their figures
    are put together from the segments (a handful of rows) instead of repeating rows per fold.
    """
    spark = df.sparkSession
    cut = fold_segments(df, date, row_id, folds)
    segments = df.groupBy(cut.number.alias("segment")).agg(
        F.count(F.lit(1)).alias("n"), F.min(date).alias("first"), F.max(date).alias("last")
    )
    spans = []
    for f in folds:
        for role, start, end in (
            ("train", f.train_start, f.train_end),
            ("test", f.test_start, f.test_end),
        ):
            spans += [(f.number, role, start, end, s) for s in cut.within(start, end)]
    wanted = spark.createDataFrame(
        spans, "fold int, role string, start_row bigint, end_row bigint, segment int"
    )
    return (
        segments.join(F.broadcast(wanted), "segment")
        .groupBy("fold", "role", "start_row", "end_row")
        .agg(
            F.sum("n").alias("rows"),
            F.min("first").alias("first_day"),
            F.max("last").alias("last_day"),
        )
    )
