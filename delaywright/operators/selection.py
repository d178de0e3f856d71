"""Exact order statistics and quantiles without sorting the table or gathering it.

A mergeable quantile sketch proposes a bracket around each wanted rank, exact counts confirm
or correct it, and the next pass looks only inside. Each pass narrows a bracket by a factor of
several thousand and is a pair of scans with partial aggregation (no row is shuffled). Once a
bracket holds few enough rows it is finished inside one bounded aggregate.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINISH_ROWS = 20_000
SKETCH_ACCURACY = 10_000


@dataclass
class _Target:
    column: str
    rank: int  # 1-based among non-null values, always relative to the whole column
    low: Any = None  # exclusive
    high: Any = None  # exclusive
    below: int = 0
    inside: int = 0
    value: Any = None
    done: bool = field(default=False)

    def bracket(self) -> Column:
        col = F.col(self.column)
        condition = col.isNotNull()
        if self.low is not None:
            condition = condition & (col > F.lit(self.low))
        if self.high is not None:
            condition = condition & (col < F.lit(self.high))
        return condition

    def settle(self, value: Any) -> None:
        self.value, self.done = value, True


def order_statistics(
    df: DataFrame,
    wanted: list[tuple[str, int]],
    counts: dict[str, int] | None = None,
    finish_rows: int = FINISH_ROWS,
) -> list[Any]:
    """The k-th smallest non-null value of a column, for each ``(column, k)``, k from 1.

    NaN is no number and counts as null. ``counts`` (from :func:`non_null_counts`) saves one job.
    """
    columns = sorted({column for column, _ in wanted})
    df = numbers(df, columns)
    if counts is None:
        counts = non_null_counts(df, columns)
    targets = {}
    for column, rank in wanted:
        if not 1 <= rank <= counts[column]:
            raise ValueError(f"rank {rank} outside 1..{counts[column]} for {column}")
        targets[column, rank] = _Target(column, rank, inside=counts[column])
    while True:
        open_targets = [t for t in targets.values() if not t.done]
        wide = [t for t in open_targets if t.inside > finish_rows]
        if not wide:
            break
        _narrow(df, wide)
    _finish(df, open_targets)
    return [targets[key].value for key in wanted]


def numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns with NaN as null, so that counts, sketches and comparisons agree on it."""
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")}
    return df.select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floating else F.col(c) for c in columns]
    )


def non_null_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    return numbers(df, columns).agg(*[F.count(c).alias(c) for c in columns]).first().asDict()


def _grid_edges(target: _Target) -> tuple[float, float]:
    """Probabilities around the target on a fixed grid, so that close ranks ask for the same."""
    at = target.rank - target.below
    step = SKETCH_ACCURACY // 2
    low = math.floor(at / target.inside * step) - 1
    high = math.ceil(at / target.inside * step) + 1
    return max(0, low) / step, min(step, high) / step


def _narrow(df: DataFrame, targets: list[_Target]) -> None:
    groups: dict[tuple, list[_Target]] = {}
    for t in targets:
        groups.setdefault((t.column, t.low, t.high), []).append(t)
    # one sketch per column and bracket, asked for all probabilities at once
    asked = [sorted({p for t in members for p in _grid_edges(t)}) for members in groups.values()]
    sketches = []
    for i, (members, probabilities) in enumerate(zip(groups.values(), asked)):
        picked = F.when(members[0].bracket(), F.col(members[0].column))
        wanted = F.array(*[F.lit(p) for p in probabilities])
        sketches.append(F.percentile_approx(picked, wanted, SKETCH_ACCURACY).alias(f"s{i}"))
    proposal = df.agg(*sketches).first()

    edges = [sorted(set(found)) for found in proposal]
    checks = []
    for i, members in enumerate(groups.values()):
        col, inside = F.col(members[0].column), members[0].bracket()
        for j, edge in enumerate(edges[i]):
            checks.append(F.count_if(inside & (col < F.lit(edge))).alias(f"l{i}_{j}"))
            checks.append(F.count_if(inside & (col == F.lit(edge))).alias(f"e{i}_{j}"))
    measured = df.agg(*checks).first()

    for i, members in enumerate(groups.values()):
        for t in members:
            start, end = t.below, t.below + t.inside
            for j, edge in enumerate(edges[i]):
                before = start + measured[f"l{i}_{j}"]
                equal = measured[f"e{i}_{j}"]
                if before < t.rank <= before + equal:
                    t.settle(edge)
                    break
                if t.rank <= before:
                    t.high, end = edge, before
                    break
                t.low, t.below = edge, before + equal
            t.inside = end - t.below


def _finish(df: DataFrame, targets: list[_Target]) -> None:
    if not targets:
        return
    picks = []
    for i, t in enumerate(targets):
        gathered = F.sort_array(F.collect_list(F.when(t.bracket(), F.col(t.column))))
        picks.append(F.element_at(gathered, t.rank - t.below).alias(f"v{i}"))
    row = df.agg(*picks).first()
    for i, t in enumerate(targets):
        t.settle(row[i])


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], finish_rows: int = FINISH_ROWS
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation for several columns at once."""
    counts = non_null_counts(df, columns)
    wanted, plan = [], {}
    for column in columns:
        n = counts[column]
        for p in probabilities:
            if n == 0:
                continue
            at = p * (n - 1)
            low, high = math.floor(at) + 1, math.ceil(at) + 1
            plan[column, p] = (low, high, at - math.floor(at))
            wanted += [(column, low), (column, high)]
    wanted = sorted(set(wanted))
    found = dict(zip(wanted, order_statistics(df, wanted, counts, finish_rows))) if wanted else {}
    result: dict[str, list[float | None]] = {}
    for column in columns:
        result[column] = []
        for p in probabilities:
            if (column, p) not in plan:
                result[column].append(None)
                continue
            low, high, fraction = plan[column, p]
            a, b = float(found[column, low]), float(found[column, high])
            result[column].append(a + (b - a) * fraction)
    return result
