"""Keyed work that stays balanced when one key owns a large part of the rows.

Two building blocks:

* ``attach``   joins a per-key summary back to its rows. Keys above ``rows_per_task`` are
  split over several salts; all other keys join as usual.
* ``OrderedScan`` evaluates row numbers, previous, last and next known values, and values some
  time back, per key. All rows go through one shuffle: those of an ordinary key together, those of
  a key above ``rows_per_task`` by slices of the sort order, whose bounds come from a sample. The
  slices are evaluated on their own and connected by a small carry table.

The set of hot keys never exceeds ``rows / rows_per_task`` entries, which is what makes
broadcasting it safe.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaywright.runtime import cut_lineage, spool

#: A million rows of a feature table take some 400 MB in a task that sorts them.
ROWS_PER_TASK = 1_000_000

_SALT = "_salt"
_SLICE = "_slice"
_SLICES = "_slices"


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], prefix: str = "") -> Column:
    """Null-safe equality on every key (a window groups nulls together, so does this)."""
    condition = None
    for key in keys:
        term = left[key].eqNullSafe(right[prefix + key])
        condition = term if condition is None else condition & term
    return condition


def _prefixed(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({key: prefix + key for key in keys})


def attach(
    rows: DataFrame,
    summary: DataFrame,
    keys: list[str],
    weight: str,
    spread_by: list[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join ``summary`` (one row per key) back to ``rows``; every row of ``rows`` is kept.

    ``weight`` is the summary column with the number of rows of the key. It tells how many
    salts a key needs; ``spread_by`` names columns (an id) whose hash picks the salt of a row.
    """
    slices = F.ceil(F.col(weight) / F.lit(rows_per_task)).cast("int")
    hot = _prefixed(
        summary.filter(F.col(weight) > rows_per_task).select(*keys, slices.alias(_SLICES)),
        keys,
        "_h_",
    )
    salted_rows = (
        rows.join(F.broadcast(hot), same_keys(rows, hot, keys, "_h_"), "left")
        .withColumn(
            _SALT,
            F.coalesce(
                F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.col(_SLICES)), F.lit(0)
            ).cast("int"),
        )
        .drop(_SLICES, *["_h_" + key for key in keys])
    )
    salted_summary = _prefixed(
        summary.withColumn("_s_" + _SALT, F.explode(F.sequence(F.lit(0), F.greatest(slices, F.lit(1)) - 1))),
        keys,
        "_s_",
    )
    condition = same_keys(salted_rows, salted_summary, keys, "_s_") & (
        salted_rows[_SALT] == salted_summary["_s_" + _SALT]
    )
    return salted_rows.join(salted_summary, condition, "left").drop(
        _SALT, "_s_" + _SALT, *["_s_" + key for key in keys]
    )


@dataclass(frozen=True)
class Position:
    """1-based position of the row within its key."""


@dataclass(frozen=True)
class Previous:
    """Value of ``column`` on the preceding row of the key (null on the first row)."""

    column: str


@dataclass(frozen=True)
class LastKnown:
    """Latest non-null value of ``column`` up to and including the row."""

    column: str


@dataclass(frozen=True)
class NextKnown:
    """Earliest non-null value of ``column`` from the row on."""

    column: str


@dataclass(frozen=True)
class LastBefore:
    """Value of ``column`` (null or not) on the latest row at least ``lead`` before the row.

    ``lead`` is SQL text that is subtracted from the first column of the order, a number or time:
    ``INTERVAL 2 HOURS``. Of rows with the same time the last one in the order counts. A scan with
    this output can have outputs of this kind and lead only."""

    column: str
    lead: str


@dataclass(frozen=True)
class Total:
    """Sum of ``column`` up to and including the row; nulls add nothing."""

    column: str


Running = Position | Total | Previous | LastKnown | NextKnown | LastBefore

#: Sampled rows for each slice of a hot key; bounds that are looked through at once.
_SAMPLES = 100
_CHUNK = 64
_BOUNDS, _ASKS, _MOVED = "_bounds", "_asks", "_moved"


@dataclass(frozen=True)
class OrderedScan:
    """Running values per key in the ascending order of ``order_by``.

    ``order_by`` must identify a row within its key (end it with an id), so results do not
    depend on how the rows are distributed.
    """

    keys: list[str]
    order_by: list[str]
    rows_per_task: int = ROWS_PER_TASK

    def run(self, df: DataFrame, measured_on: DataFrame | None = None, **outputs: Running) -> DataFrame:
        """Add the outputs to ``df``.

        The group sizes are counted first; ``measured_on`` names a cheaper frame with the same
        keys and order (the scan ``df`` was derived from), so that ``df`` is evaluated only once.
        """
        return self.run_measured(df, self.measure(df if measured_on is None else measured_on), **outputs)

    def run_measured(self, df: DataFrame, bounds: DataFrame | None, **outputs: Running) -> DataFrame:
        """As :meth:`run`, with the result of :meth:`measure`, which several scans can share."""
        leads = {op.lead for op in outputs.values() if isinstance(op, LastBefore)}
        if leads and (len(leads) > 1 or not all(isinstance(op, LastBefore) for op in outputs.values())):
            raise ValueError("values some time back are a scan of their own")
        if bounds is None:
            return df.select("*", *[self._local(op, self.keys).alias(name) for name, op in outputs.items()])
        return self._sliced(df, bounds, outputs, next(iter(leads), None))

    def _hot_keys(self, df: DataFrame) -> tuple[DataFrame, int]:
        sizes = df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_n"))
        hot = sizes.filter(F.col("_n") > self.rows_per_task)
        total = hot.agg(F.sum("_n")).first()[0] or 0
        return _prefixed(hot.select(*self.keys), self.keys, "_h_"), total

    def measure(self, df: DataFrame) -> DataFrame | None:
        """Hot keys with the least order values of all their slices but the first; None without any."""
        hot, rows = self._hot_keys(df)
        if not rows:
            return None
        hot = cut_lineage(hot)
        place = F.struct(*self.order_by).alias("_at")
        heavy = df.join(F.broadcast(hot), same_keys(df, hot, self.keys, "_h_"), "left_semi").select(*self.keys, place)
        share = min(1.0, _SAMPLES / self.rows_per_task)
        drawn = heavy if share == 1.0 else heavy.sample(share, seed=1)
        known = drawn.groupBy(*self.keys).agg(F.sort_array(F.collect_list("_at")).alias("_all"))
        slices = F.greatest(F.lit(2), F.ceil(F.size("_all") / (self.rows_per_task * share)).cast("int"))
        picked = F.transform(
            F.sequence(F.lit(1), slices - 1),
            lambda i: F.get("_all", F.floor(i * F.size("_all") / slices).cast("int")),
        )
        return cut_lineage(_prefixed(known.select(*self.keys, F.array_distinct(picked).alias(_BOUNDS)), self.keys, "_h_"))

    def _sliced(self, df: DataFrame, bounds: DataFrame, outputs: dict[str, Running], lead: str | None) -> DataFrame:
        marked = df.join(F.broadcast(bounds), same_keys(df, bounds, self.keys, "_h_"), "left")
        marked = marked.withColumn(_SLICE, _bounds_below(lambda b: b <= F.struct(*self.order_by)))
        if lead is None:
            marked = marked.withColumn(_MOVED, F.lit(False)).withColumn(_ASKS, F.lit(False))
        else:
            # What lies ``lead`` back may belong to an earlier slice. A copy of the row asks there:
            # it comes after all rows of that slice, and none of them sees it.
            cut_off = F.col(self.order_by[0]) - F.expr(lead)
            target = _bounds_below(lambda b: b[self.order_by[0]] <= cut_off)
            own = F.struct(F.col(_SLICE).alias("at"), F.lit(False).alias("asks"))
            copy = F.struct(F.col("_target").alias("at"), F.lit(True).alias("asks"))
            both = F.when(F.col("_target") < F.col(_SLICE), F.array(own, copy)).otherwise(F.array(own))
            marked = (
                marked.withColumn("_target", target)
                .withColumn(_MOVED, F.col("_target") < F.col(_SLICE))
                .withColumn("_place", F.explode(both))
                .withColumn(_SLICE, F.col("_place.at"))
                .withColumn(_ASKS, F.col("_place.asks"))
            )
        by = [*self.keys, _SLICE]
        hot = F.col(_BOUNDS).isNotNull().alias("_hot")
        local = spool(
            marked.select(
                *[F.col(c) for c in df.columns],
                _SLICE,
                _ASKS,
                _MOVED,
                hot,
                F.row_number().over(Window.partitionBy(*by).orderBy(*self.order_by)).alias("_at"),
                *[self._local(op, by, _ASKS).alias(f"_l_{name}") for name, op in outputs.items()],
            ),
            "ordered",
        )
        carry = F.broadcast(self._carry(local.filter(F.col("_hot") & ~F.col(_ASKS)), outputs))
        # A row that asks elsewhere is answered there.
        answered = local.filter(F.col(_ASKS) | ~F.col(_MOVED))
        joined = answered.join(
            carry,
            F.col("_hot") & same_keys(answered, carry, self.keys, "_c_") & (answered[_SLICE] == carry["_c_" + _SLICE]),
            "left",
        )
        return joined.select(
            *[answered[c] for c in df.columns],
            *[_connect(name, op).alias(name) for name, op in outputs.items()],
        )

    def _local(self, op: Running, by: list[str], asks: str | None = None) -> Column:
        """The output within one key or slice (``by``); rows marked ``asks`` are seen by no other."""
        if isinstance(op, LastBefore):
            time = _quoted(self.order_by[0])
            fields = [*self.order_by, op.column]
            record = ", ".join(f"'{n}', {_quoted(c)}" for n, c in zip(self._fields(), fields, strict=True))
            unseen = "" if asks is None else f" AND NOT {_quoted(asks)}"
            # Spans of time as a frame's bounds can only be written in SQL.
            back = F.expr(
                f"max(CASE WHEN {time} IS NOT NULL{unseen} THEN named_struct({record}) END) OVER ("
                f"PARTITION BY {', '.join(map(_quoted, by))} ORDER BY {time} "
                f"RANGE BETWEEN UNBOUNDED PRECEDING AND {op.lead} PRECEDING)"
            )
            return back if asks is not None else back["value"]
        ordered = Window.partitionBy(*by).orderBy(*self.order_by)
        if isinstance(op, Position):
            return F.row_number().over(ordered).cast("bigint")
        if isinstance(op, Previous):
            return F.lag(op.column).over(ordered)
        if isinstance(op, Total):
            sums = F.sum(op.column).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            return F.coalesce(sums, F.lit(0))
        if isinstance(op, NextKnown):
            # Backwards: a frame up to the end would be walked through anew for every row.
            ordered = Window.partitionBy(*by).orderBy(*[F.desc_nulls_last(c) for c in self.order_by])
        return F.last(op.column, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def _fields(self) -> list[str]:
        return [*[f"o{i}" for i in range(len(self.order_by))], "value"]

    def _record(self, op: LastBefore) -> Column:
        fields = zip(self._fields(), [*self.order_by, op.column], strict=True)
        return F.struct(*[F.col(c).alias(n) for n, c in fields])

    def _carry(self, staged: DataFrame, outputs: dict[str, Running]) -> DataFrame:
        """Per hot key and slice: what the other slices hand over (one row per slice)."""
        order = F.struct(*self.order_by)
        closing = [F.count(F.lit(1)).alias("_n")]
        for name, op in outputs.items():
            if isinstance(op, Total):
                closing.append(F.sum(op.column).alias(f"_v_{name}"))
            elif isinstance(op, Previous):
                closing.append(F.max_by(F.struct(op.column), order).alias(f"_v_{name}"))
            elif isinstance(op, LastKnown | NextKnown):
                known = F.when(F.col(op.column).isNotNull(), order)
                pick = F.max_by if isinstance(op, LastKnown) else F.min_by
                closing.append(pick(F.struct(op.column), known).alias(f"_v_{name}"))
            elif isinstance(op, LastBefore):
                seen = F.col(self.order_by[0]).isNotNull()
                closing.append(F.max(F.when(seen, self._record(op))).alias(f"_v_{name}"))
        summary = staged.groupBy(*self.keys, _SLICE).agg(*closing)
        by_slice = Window.partitionBy(*self.keys).orderBy(_SLICE)
        before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
        after = Window.partitionBy(*self.keys).orderBy(F.desc(_SLICE)).rowsBetween(Window.unboundedPreceding, -1)
        handed = []
        for name, op in outputs.items():
            if isinstance(op, Position):
                value = F.coalesce(F.sum("_n").over(before), F.lit(0))
            elif isinstance(op, Total):
                value = F.coalesce(F.sum(f"_v_{name}").over(before), F.lit(0))
            elif isinstance(op, Previous):
                value = F.lag(f"_v_{name}").over(by_slice)[op.column]
            elif isinstance(op, LastBefore):
                value = F.max(f"_v_{name}").over(before)
            else:
                frame = before if isinstance(op, LastKnown) else after
                value = F.last(F.col(f"_v_{name}")[op.column], ignorenulls=True).over(frame)
            handed.append(value.alias(f"_p_{name}"))
        return _prefixed(summary.select(*self.keys, _SLICE, *handed), [*self.keys, _SLICE], "_c_")


def _bounds_below(below: Callable[[Column], Column]) -> Column:
    """How many of a key's ascending bounds are ``below``; 0 for a key without any. Whole chunks
    are told by their last bound."""
    ends = F.filter(_BOUNDS, lambda b, i: (i % _CHUNK == _CHUNK - 1) & below(b))
    rest = F.slice(_BOUNDS, F.size(ends) * _CHUNK + 1, F.lit(_CHUNK))
    return F.when(F.col(_BOUNDS).isNull(), 0).otherwise(F.size(ends) * _CHUNK + F.size(F.filter(rest, below))).cast("int")


def _quoted(column: str) -> str:
    return f"`{column}`"


def _connect(name: str, op: Running) -> Column:
    local, carried = F.col(f"_l_{name}"), F.col(f"_p_{name}")
    if isinstance(op, Position | Total):
        return local + F.coalesce(carried, F.lit(0))
    if isinstance(op, Previous):
        return F.when(F.col("_at") == 1, carried).otherwise(local)
    if isinstance(op, LastBefore):
        return F.coalesce(local, carried)["value"]
    return F.coalesce(local, carried)


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread_by: list[str],
    max_rows: int = 200_000,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left join of ``rows`` with an aggregate that has one row per key; null keys match nothing.

    The lookup is materialised and broadcast if it has at most ``max_rows`` rows. A larger one is
    joined by shuffle, with the keys that own many rows spread over several salts.
    """
    kept = cut_lineage(lookup)
    if kept.limit(max_rows + 1).count() <= max_rows:
        return rows.join(F.broadcast(kept), keys, "left")
    weights = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_weight"))
    return attach(rows, kept.join(weights, keys), keys, "_weight", spread_by, rows_per_task).drop("_weight")
