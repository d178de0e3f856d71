"""The engineered feature table of a flight, built with two row shuffles and a rank lookup.

Calendar, cyclical and class features are one projection. The congestion count joins per-minute
counts back by airport; sequence and prior delay follow the aircraft.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaywright.functions import expressions as fx
from delaywright.operators import windows
from delaywright.operators.delay_rank import rolling_airport_ranks, with_origin_rank
from delaywright.operators.skew import ROWS_PER_TASK, OrderedScan, Position, Previous

# Names of the engineered columns.
ENGINEERED = [
    "crs_dep_time_minutes_from_midnight",
    "crs_dep_hour_sin",
    "crs_dep_hour_cos",
    "crs_dep_day_of_year_sin",
    "crs_dep_day_of_year_cos",
    "crs_dep_time_part_of_day",
    "tail_num_flight_seq_num",
    "parallel_flights",
    "prior_flight_dep_delay_new",
    "prior_flight_origin_delay_pagerank",
    "christmas_travel",
    "federal_holiday_indicator",
    "recency_days",
]


def calendar_features(
    df: DataFrame, clock: str, date: str, as_of: Column | dt.date
) -> DataFrame:
    """Features that depend on one row only."""
    hour_sin, hour_cos = fx.cyclic(fx.clock_hour(clock), 24)
    day_sin, day_cos = fx.cyclic(F.dayofyear(date), 365)
    projected = df.select(
        "*",
        fx.clock_minutes(clock).alias("crs_dep_time_minutes_from_midnight"),
        hour_sin.alias("crs_dep_hour_sin"),
        hour_cos.alias("crs_dep_hour_cos"),
        day_sin.alias("crs_dep_day_of_year_sin"),
        day_cos.alias("crs_dep_day_of_year_cos"),
        fx.part_of_day(clock).alias("crs_dep_time_part_of_day"),
        fx.christmas_travel(date).alias("christmas_travel"),
        fx.recency_days(date, as_of).alias("recency_days"),
    )
    return fx.with_holiday_indicator(projected, date)


def flight_features(
    df: DataFrame,
    as_of: Column | dt.date | None = None,
    row_id: str = "flight_id",
    timestamp: str = "dep_ts",
    date: str = "fl_date",
    clock: str = "crs_dep_time",
    airport: str = "origin",
    destination: str = "dest",
    aircraft: str = "tail_num",
    delay: str = "dep_delay",
    rows_per_task: int = ROWS_PER_TASK,
    lead_hours: int = 2,
) -> DataFrame:
    """Add all engineered features to a flight frame; no row is added or lost. The prior flight's
    delay is that of the aircraft's latest flight known ``lead_hours`` before departure; the rank of
    the airport it came from is that over the delays of the days before the flight's own.

    ``as_of`` fixes the reference day of ``recency_days``; by default it is the latest date.
    """
    as_of = as_of if as_of is not None else df.agg(F.max(date)).first()[0]
    if as_of is None:
        raise ValueError("no dated rows")
    base = calendar_features(df, clock, date, as_of)
    minute = base.withColumn("_minute", fx.epoch_minutes(timestamp))
    crowded = windows.flights_within(minute, [airport], "_minute", row_id, 15, rows_per_task=rows_per_task)
    measured = df.select(aircraft, date, timestamp, row_id)
    # One shuffle by aircraft serves all three scans: numbering by day needs none of its own.
    order = [timestamp, row_id]
    of_aircraft = OrderedScan([aircraft], order, rows_per_task)
    bounds = of_aircraft.measure(measured)
    followed = of_aircraft.run_measured(crowded.drop("_minute"), bounds, _prior_airport=Previous(airport))
    followed = of_aircraft.run_measured(followed, bounds, _prior=windows.delay_before(delay, lead_hours))
    of_day = OrderedScan([aircraft, date], order, rows_per_task)
    # Without a busy aircraft there is no busy day of one.
    days = None if bounds is None else of_day.measure(measured)
    numbered = of_day.run_measured(followed, days, tail_num_flight_seq_num=Position())
    ranks = rolling_airport_ranks(df.withColumn("_late", fx.positive_part(delay)), date, airport, destination, "_late")
    ranked = with_origin_rank(numbered, ranks, date, "_prior_airport", row_id, rows_per_task=rows_per_task)
    prior = F.when(F.col(aircraft).isNotNull(), fx.positive_part("_prior"))
    return ranked.withColumn("prior_flight_dep_delay_new", prior).drop("_prior", "_prior_airport")
