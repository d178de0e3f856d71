"""Schedule features: order, congestion, sequence and latest known delay.

Features that depend on the minute of a departure are computed on per-minute summaries (at most
1440 rows per airport and day) and joined back, so a busy airport never becomes one big window.
Features that follow single rows (sequence, previous delay) use ``OrderedScan``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaywright.functions.expressions import positive_part
from delaywright.operators.skew import (
    ROWS_PER_TASK,
    LastBefore,
    OrderedScan,
    Position,
    Previous,
    attach,
)


def departure_order(
    df: DataFrame,
    group: list[str],
    time: str,
    row_id: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Order of a departure among those of its airport and day (``group``).

    Adds ``parallel_flights`` (departures at the same scheduled time, itself included),
    ``same_dep_time`` (true when the preceding departure has the same time; null on the very
    first one; rows of equal time are ordered by ``row_id``) and ``flight_order`` (number of
    different times up to this one).
    """
    slots = df.groupBy(*group, time).agg(
        F.count(F.lit(1)).alias("parallel_flights"), F.min(row_id).alias("_first_id")
    )
    by_time = Window.partitionBy(*group).orderBy(time)
    ordered = slots.withColumn("flight_order", F.dense_rank().over(by_time).cast("bigint"))
    joined = attach(df, ordered, [*group, time], "parallel_flights", [row_id], rows_per_task)
    leads_slot = F.col(row_id) == F.col("_first_id")
    same = (
        F.when(~leads_slot, F.lit(True))
        .when(F.col("flight_order") > 1, F.lit(False))
    )
    return joined.withColumn("same_dep_time", same).drop("_first_id")


def flights_within(
    df: DataFrame,
    group: list[str],
    minute: str,
    row_id: str,
    minutes: int = 15,
    output: str = "parallel_flights",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Departures of the same airport within ± ``minutes`` of a row, itself included.

    ``minute`` is a running minute number (it does not restart at midnight). Per-minute counts
    are cut into day-long blocks; a minute is repeated in every block it reaches, so each window
    holds at most ``1440 + 2 * minutes`` rows. A row without a minute has no count (null).
    """
    slots = df.groupBy(*group, minute).agg(F.count(F.lit(1)).alias("_here"))
    block = F.floor(F.col(minute) / 1440)
    blocks = F.sequence(F.floor((F.col(minute) - minutes) / 1440), F.floor((F.col(minute) + minutes) / 1440))
    spread = slots.withColumn("_home", block).withColumn("_block", F.explode(blocks))
    around = (
        Window.partitionBy(*group, "_block").orderBy(minute).rangeBetween(-minutes, minutes)
    )
    counted = (
        spread.withColumn(output, F.sum("_here").over(around))
        .filter(F.col("_block") == F.col("_home"))
        .select(*group, minute, "_here", output)
    )
    return attach(df, counted, [*group, minute], "_here", [row_id], rows_per_task).drop("_here")


def last_known_delay(
    df: DataFrame,
    group: list[str],
    minute: str,
    delay: str,
    row_id: str,
    lead_minutes: int = 180,
    output: str = "dep_delay_previous",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Latest known delay among departures of the group at least ``lead_minutes`` earlier, else 0.

    "Latest" is the highest (minute, id) with a delay that is not null. ``minute`` counts from
    midnight and the group contains the date.
    """
    known = F.when(F.col(delay).isNotNull(), F.col(row_id))
    slots = df.groupBy(*group, minute).agg(
        F.count(F.lit(1)).alias("_rows"), F.max_by(F.col(delay), known).alias("_delay")
    )
    earlier = (
        Window.partitionBy(*group)
        .orderBy(minute)
        .rangeBetween(Window.unboundedPreceding, -lead_minutes)
    )
    looked_up = slots.select(
        *group,
        minute,
        "_rows",
        F.coalesce(F.last("_delay", ignorenulls=True).over(earlier), F.lit(0.0)).alias(output),
    )
    return attach(df, looked_up, [*group, minute], "_rows", [row_id], rows_per_task).drop("_rows")


def number_rows(
    df: DataFrame,
    group: list[str],
    order_by: list[str],
    output: str = "row_number",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """1-based position within the group (aircraft and day: the n-th flight of that day)."""
    return OrderedScan(group, order_by, rows_per_task).run(df, **{output: Position()})


def prior_delay(
    df: DataFrame,
    group: list[str],
    order_by: list[str],
    delay: str,
    output: str = "prior_flight_dep_delay_new",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Delay of the aircraft's preceding flight, early departures as 0, null on its first flight.

    The preceding flight may have left a moment ago; :func:`known_prior_delay` uses only what is
    known some hours before.
    """
    scanned = OrderedScan(group, order_by, rows_per_task).run(df, **{output: Previous(delay)})
    return scanned.withColumn(output, positive_part(output))


def known_prior_delay(
    df: DataFrame,
    aircraft: str,
    timestamp: str,
    row_id: str,
    delay: str,
    lead_hours: int = 2,
    output: str = "prior_flight_dep_delay_new",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Delay of the aircraft's latest flight that left at least ``lead_hours`` before a row does,
    early departures as 0; null without such a flight, and for an unknown aircraft or time.

    Of flights with the same time the one with the highest id counts.
    """
    scan = OrderedScan([aircraft], [timestamp, row_id], rows_per_task)
    found = scan.run(df, **{output: delay_before(delay, lead_hours)})
    return found.withColumn(output, F.when(F.col(aircraft).isNotNull(), positive_part(output)))


def delay_before(delay: str, lead_hours: int) -> LastBefore:
    return LastBefore(delay, f"INTERVAL {int(lead_hours)} HOURS")


def prior_value(
    df: DataFrame,
    group: list[str],
    order_by: list[str],
    column: str,
    output: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    return OrderedScan(group, order_by, rows_per_task).run(df, **{output: Previous(column)})
