"""Joins by time and by nearness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaywright.operators.skew import ROWS_PER_TASK, LastKnown, NextKnown, OrderedScan, join_lookup


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_time: Column | str,
    right_time: Column | str,
    left_id: str,
    right_id: str,
    payload: list[str],
    prefix: str = "",
    rows_per_task: int = ROWS_PER_TASK,
    measured_left: DataFrame | None = None,
) -> DataFrame:
    """For each left row, the latest right row of the same key at or before the left time.

    Both sides go into one ordered stream per key and the last right row is carried forward, so
    no pair of rows is ever built. ``left_time`` may be an expression such as the departure
    minus two hours. Of right rows with the same time the highest ``right_id`` wins. Left rows
    without a match keep nulls; a null in a key matches nothing, on either side. ``measured_left`` names a cheaper frame with the same keys,
    times and ids as ``left`` for counting the group sizes.
    """
    stream, sizes, keys = _stream(left, right, on, left_time, right_time, left_id, right_id, payload, measured_left)
    scan = OrderedScan(keys, ["_t", "_side", "_id"], rows_per_task)
    carried = scan.run(stream, measured_on=sizes, _match=LastKnown("_right")).filter(F.col("_side") == 1)
    # a left row without a time sorts first and must not match
    match = F.when(F.col("_t").isNotNull(), F.col("_match"))
    return carried.select(
        *[F.col("_left")[c].alias(c) for c in left.columns],
        *[match[c].alias(prefix + c) for c in payload],
    )


def _stream(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_time: Column | str,
    right_time: Column | str,
    left_id: str,
    right_id: str,
    payload: list[str],
    measured_left: DataFrame | None,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides in one frame ``keys, _t, _side, _id, _left, _right`` (right rows are side 0 and
    come first at equal times), a cheaper frame with its keys and order, and the keys."""
    clock = F.col(left_time) if isinstance(left_time, str) else left_time
    stamp = F.col(right_time) if isinstance(right_time, str) else right_time
    record = F.struct(*[F.col(c) for c in payload])
    whole = F.struct(*[F.col(c) for c in left.columns])
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(on)]
    unknown = F.lit(False)
    for k in on:
        unknown = unknown | F.col(k).isNull()
    # Left rows without a key are spread over many groups: together they would be one hot key.
    spread = F.when(unknown, F.pmod(F.xxhash64(left_id), F.lit(4096))).otherwise(0).cast("int").alias("_null")
    known = right.filter(~unknown)
    l_stream = left.select(
        *named,
        spread,
        clock.alias("_t"),
        F.lit(1).alias("_side"),
        F.col(left_id).alias("_id"),
        whole.alias("_left"),
    )
    r_stream = known.filter(stamp.isNotNull()).select(
        *named,
        F.lit(0).alias("_null"),
        stamp.alias("_t"),
        F.lit(0).alias("_side"),
        F.col(right_id).alias("_id"),
        record.alias("_right"),
    )
    stream = l_stream.unionByName(r_stream, allowMissingColumns=True)
    keys = [*[f"_k{i}" for i in range(len(on))], "_null"]
    order = ["_t", "_side", "_id"]
    measured = (left if measured_left is None else measured_left).select(
        *named, spread, clock.alias("_t"), F.lit(1).alias("_side"), F.col(left_id).alias("_id")
    )
    return stream, measured.unionByName(r_stream.select(*keys, *order)), keys


def nearest_per_key(pairs: DataFrame, key: str, candidate: str, distance: str) -> DataFrame:
    """Nearest candidate per key from a table of known distances; ties take the lowest candidate."""
    best = F.min(F.struct(F.col(distance), F.col(candidate)))
    return pairs.groupBy(key).agg(best.alias("_best")).select(
        key,
        F.col("_best")[candidate].alias(candidate),
        F.col("_best")[distance].alias(distance),
    )


def with_station_reports(
    df: DataFrame,
    stations: DataFrame,
    reports: DataFrame,
    airport: str,
    timestamp: str,
    row_id: str,
    station: str,
    report_time: str,
    report_id: str,
    readings: list[str],
    lead_hours: int = 2,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the ``readings`` of the latest report, at least ``lead_hours`` before departure, of the
    station that belongs to the airport.

    ``stations`` has one row for each airport, with ``station`` and any other columns to add (its
    distance); ``reports`` has ``station``, ``report_time``, ``report_id`` and the readings. Flights
    without a station or an earlier report keep nulls.
    """
    placed = join_lookup(df, stations, [airport], [row_id], rows_per_task=rows_per_task)
    cut_off = F.col(timestamp) - F.expr(f"INTERVAL {int(lead_hours)} HOURS")
    return asof_join(
        placed, reports, [station], cut_off, report_time, row_id, report_id, readings, rows_per_task=rows_per_task
    )


def nearest_by_value(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_value: str,
    right_value: str,
    left_id: str,
    right_id: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Per left row the right row of the same key with the closest value (lowest id on ties).

    The closest value is the next one below or the next one above. Both sides go into one ordered
    stream per key; the last right row is carried forward and the next one backward, in the same
    pass, instead of comparing every left row with every right row of the key. A left row without
    a value has no nearest row.
    """
    points = right.groupBy(*on, right_value).agg(F.min(right_id).alias(right_id))
    payload = [right_value, right_id]
    stream, sizes, keys = _stream(left, points, on, left_value, right_value, left_id, right_id, payload, None)
    scan = OrderedScan(keys, ["_t", "_side", "_id"], rows_per_task)
    around = scan.run(stream, measured_on=sizes, _below=LastKnown("_right"), _above=NextKnown("_right"))
    known = around.filter(F.col("_side") == 1)

    def candidate(side: str) -> Column:
        gap = F.abs(F.col(side)[right_value] - F.col("_t"))
        return F.when(
            F.col(side).isNotNull() & F.col("_t").isNotNull(), F.struct(gap.alias("gap"), F.col(side)[right_id].alias("nearest"))
        )

    best = F.least(candidate("_below"), candidate("_above"))
    return known.select(
        *[F.col("_left")[c].alias(c) for c in left.columns], best["nearest"].alias(right_id), best["gap"].alias("gap")
    )
