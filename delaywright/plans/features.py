"""Scalar features and window features of a flight."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaywright.functions import expressions as fx
from delaywright.operators import cleaning, windows
from delaywright.operators.delay_rank import STEPS, WINDOW_DAYS, rolling_airport_ranks, with_origin_rank
from delaywright.operators.feature_table import ENGINEERED, flight_features
from delaywright.plans.registry import query
from delaywright.plans.views import FLIGHTS, flights, rounded, sql_rounded, table

MINUTES = "CAST(floor(crs_dep_time / 100) * 60 + crs_dep_time % 100 AS INTEGER)"
HOUR = "CAST(floor(crs_dep_time / 100) AS INTEGER)"
PART_OF_DAY = f"""CASE WHEN {HOUR} BETWEEN 5 AND 11 THEN 'Morning'
  WHEN {HOUR} BETWEEN 12 AND 17 THEN 'Afternoon' ELSE 'Night' END"""
HOLIDAY_RULES = """(
      (month(d) = 1 AND day(d) = 1) OR (month(d) = 7 AND day(d) = 4) OR (month(d) = 11 AND day(d) = 11)
      OR (month(d) = 12 AND day(d) = 25)
      OR (month(d) IN (1, 2) AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21)
      OR (month(d) = 5 AND isodow(d) = 1 AND day(d) BETWEEN 25 AND 31)
      OR (month(d) = 9 AND isodow(d) = 1 AND day(d) BETWEEN 1 AND 7)
      OR (month(d) = 10 AND isodow(d) = 1 AND day(d) BETWEEN 8 AND 14)
      OR (month(d) = 11 AND isodow(d) = 4 AND day(d) BETWEEN 22 AND 28))"""


@query(
    "feat_recency_days",
    """SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE),
      (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS INTEGER) AS recency_days FROM orders""",
)
def feat_recency_days(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    latest = orders.agg(F.max("o_orderdate")).scalar()
    return orders.select("o_orderkey", fx.recency_days("o_orderdate", latest).alias("recency_days"))


@query("feat_hour", f"WITH {FLIGHTS} SELECT flight_id, {HOUR} AS crs_dep_hour FROM v_flight")
def feat_hour(spark, sf_dir):
    return flights(spark, sf_dir).select("flight_id", fx.clock_hour("crs_dep_time").alias("crs_dep_hour"))


@query(
    "feat_minutes_of_day",
    f"""WITH {FLIGHTS} SELECT flight_id, {MINUTES} AS minutes_from_midnight,
      CAST(1440 - {MINUTES} AS INTEGER) AS minutes_until_midnight FROM v_flight""",
)
def feat_minutes_of_day(spark, sf_dir):
    return flights(spark, sf_dir).select(
        "flight_id",
        fx.clock_minutes("crs_dep_time").alias("minutes_from_midnight"),
        fx.minutes_until_midnight("crs_dep_time").alias("minutes_until_midnight"),
    )


@query(
    "feat_calendar",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(quarter(ts) AS INTEGER) AS quarter,
      CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day_of_month,
      CAST(isodow(ts) AS INTEGER) AS day_of_week, CAST(dayofyear(ts) AS INTEGER) AS day_of_year FROM events""",
)
def feat_calendar(spark, sf_dir):
    parts = fx.calendar_parts("ts")
    return table(spark, sf_dir, "events").select("event_id", *[c.cast("int").alias(n) for n, c in parts.items()])


@query(
    "feat_christmas",
    """SELECT o_orderkey, CASE WHEN (month(o_orderdate) = 12 AND day(o_orderdate) >= 20)
      OR (month(o_orderdate) = 1 AND day(o_orderdate) <= 10) THEN 1 ELSE 0 END AS christmas_travel FROM orders""",
)
def feat_christmas(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fx.christmas_travel("o_orderdate").alias("christmas_travel")
    )


@query(
    "feat_holiday",
    f"""WITH day AS (SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) - INTERVAL 4 DAY FROM orders),
      (SELECT max(o_orderdate) + INTERVAL 4 DAY FROM orders), INTERVAL 1 DAY)) AS DATE) AS d),
    holiday AS (SELECT d FROM day WHERE {HOLIDAY_RULES} OR (month(d) = 6 AND day(d) = 19 AND year(d) >= 2021)),
    mark AS (SELECT day.d, max(CASE WHEN day.d = holiday.d THEN 2 ELSE 1 END) AS m
      FROM day JOIN holiday ON abs(date_diff('day', day.d, holiday.d)) <= 3 GROUP BY day.d)
    SELECT o_orderkey, CAST(coalesce(m, 0) AS INTEGER) AS federal_holiday_indicator
    FROM orders LEFT JOIN mark ON CAST(o_orderdate AS DATE) = mark.d""",
)
def feat_holiday(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return fx.with_holiday_indicator(orders, "o_orderdate").drop("o_orderdate")


@query(
    "feat_cyclic_hour",
    f"""WITH {FLIGHTS} SELECT flight_id,
      {sql_rounded(f"sin({HOUR} * (2 * pi() / 24))")} AS crs_dep_hour_sin,
      {sql_rounded(f"cos({HOUR} * (2 * pi() / 24))")} AS crs_dep_hour_cos FROM v_flight""",
)
def feat_cyclic_hour(spark, sf_dir):
    sin, cos = fx.cyclic(fx.clock_hour("crs_dep_time"), 24)
    return flights(spark, sf_dir).select(
        "flight_id", rounded(sin).alias("crs_dep_hour_sin"), rounded(cos).alias("crs_dep_hour_cos")
    )


@query(
    "feat_cyclic_doy",
    f"""WITH {FLIGHTS} SELECT flight_id,
      {sql_rounded("sin(dayofyear(fl_date) * (2 * pi() / 365))")} AS crs_dep_day_of_year_sin,
      {sql_rounded("cos(dayofyear(fl_date) * (2 * pi() / 365))")} AS crs_dep_day_of_year_cos FROM v_flight""",
)
def feat_cyclic_doy(spark, sf_dir):
    sin, cos = fx.cyclic(F.dayofyear("fl_date"), 365)
    return flights(spark, sf_dir).select(
        "flight_id",
        rounded(sin).alias("crs_dep_day_of_year_sin"),
        rounded(cos).alias("crs_dep_day_of_year_cos"),
    )


@query(
    "feat_delay_new",
    f"WITH {FLIGHTS} SELECT flight_id, round(dep_delay_new, 6) AS dep_delay_new FROM v_flight",
)
def feat_delay_new(spark, sf_dir):
    return flights(spark, sf_dir).select("flight_id", rounded("dep_delay_new").alias("dep_delay_new"))


@query(
    "feat_delay_flags",
    f"""WITH {FLIGHTS} SELECT flight_id, CASE WHEN dep_delay > 0 THEN 1 ELSE 0 END AS is_delayed,
      dep_del15, CASE WHEN dep_delay > 60 THEN 1 ELSE 0 END AS sign_delay FROM v_flight""",
)
def feat_delay_flags(spark, sf_dir):
    return flights(spark, sf_dir).select(
        "flight_id",
        fx.delay_flag("dep_delay", 0, inclusive=False).alias("is_delayed"),
        "dep_del15",
        fx.delay_flag("dep_delay", fx.SIGNIFICANT_DELAY_MINUTES, inclusive=False).alias("sign_delay"),
    )


@query(
    "feat_status_bucket",
    f"""WITH {FLIGHTS} SELECT CASE WHEN dep_delay <= 0 THEN 'On Time' WHEN dep_delay <= 15 THEN 'Small Delay'
      ELSE 'Large Delay' END AS flight_status, count(*) AS flights FROM v_flight GROUP BY 1""",
)
def feat_status_bucket(spark, sf_dir):
    status = fx.status_bucket("dep_delay").alias("flight_status")
    return flights(spark, sf_dir).groupBy(status).agg(F.count(F.lit(1)).alias("flights"))


@query("feat_part_of_day", f"WITH {FLIGHTS} SELECT flight_id, {PART_OF_DAY} AS part_of_day FROM v_flight")
def feat_part_of_day(spark, sf_dir):
    return flights(spark, sf_dir).select("flight_id", fx.part_of_day("crs_dep_time").alias("part_of_day"))


@query(
    "feat_part_of_day_code",
    f"""WITH {FLIGHTS} SELECT flight_id, CASE {PART_OF_DAY} WHEN 'Morning' THEN 1 WHEN 'Afternoon' THEN 2
      WHEN 'Night' THEN 3 END AS part_of_day_code FROM v_flight""",
)
def feat_part_of_day_code(spark, sf_dir):
    named = flights(spark, sf_dir).withColumn("part_of_day", fx.part_of_day("crs_dep_time"))
    return named.select("flight_id", fx.part_of_day_code("part_of_day").alias("part_of_day_code"))


@query(
    "clip_at_quantile",
    f"""WITH {FLIGHTS} SELECT flight_id, round(least(dep_delay_new,
      (SELECT quantile_cont(dep_delay_new, 0.95) FROM v_flight)), 6) AS dep_delay_new FROM v_flight""",
)
def clip_at_quantile(spark, sf_dir):
    base = flights(spark, sf_dir).select("flight_id", "dep_delay_new")
    clipped = cleaning.clip_at_quantile(base, "dep_delay_new", 0.95)
    return clipped.select("flight_id", rounded("dep_delay_new").alias("dep_delay_new"))


# --- windows ------------------------------------------------------------------------------------


@query(
    "win_parallel_exact",
    f"""WITH {FLIGHTS} SELECT flight_id,
      count(*) OVER (PARTITION BY fl_date, origin, crs_dep_time) AS parallel_flights FROM v_flight""",
)
def win_parallel_exact(spark, sf_dir):
    base = flights(spark, sf_dir).select("flight_id", "fl_date", "origin", "crs_dep_time")
    ordered = windows.departure_order(base, ["fl_date", "origin"], "crs_dep_time", "flight_id")
    return ordered.select("flight_id", "parallel_flights")


@query(
    "win_same_as_previous",
    f"""WITH {FLIGHTS} SELECT flight_id,
      lag(crs_dep_time) OVER (PARTITION BY fl_date, origin ORDER BY crs_dep_time, flight_id) = crs_dep_time
        AS same_dep_time FROM v_flight""",
)
def win_same_as_previous(spark, sf_dir):
    base = flights(spark, sf_dir).select("flight_id", "fl_date", "origin", "crs_dep_time")
    ordered = windows.departure_order(base, ["fl_date", "origin"], "crs_dep_time", "flight_id")
    return ordered.select("flight_id", "same_dep_time")


@query(
    "win_flight_order",
    f"""WITH {FLIGHTS}, s AS (SELECT *, lag(crs_dep_time) OVER (PARTITION BY fl_date, origin
        ORDER BY crs_dep_time, flight_id) = crs_dep_time AS same FROM v_flight)
    SELECT flight_id, CAST(sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY fl_date, origin
      ORDER BY crs_dep_time, flight_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS flight_order FROM s""",
)
def win_flight_order(spark, sf_dir):
    base = flights(spark, sf_dir).select("flight_id", "fl_date", "origin", "crs_dep_time")
    ordered = windows.departure_order(base, ["fl_date", "origin"], "crs_dep_time", "flight_id")
    return ordered.select("flight_id", "flight_order")


@query(
    "win_last_known_delay",
    f"""WITH {FLIGHTS}, m AS (SELECT flight_id, fl_date, origin % 5 AS market, dep_delay,
        {MINUTES} AS minute FROM v_flight),
    t AS (SELECT fl_date, market, minute, arg_max(dep_delay, flight_id) AS d FROM m GROUP BY ALL)
    SELECT m.flight_id, round(coalesce(t.d, 0.0), 6) AS dep_delay_previous
    FROM m ASOF LEFT JOIN t ON m.fl_date = t.fl_date AND m.market = t.market AND m.minute - 180 >= t.minute""",
)
def win_last_known_delay(spark, sf_dir):
    base = flights(spark, sf_dir).select(
        "flight_id",
        "fl_date",
        (F.col("origin") % 5).alias("market"),
        fx.clock_minutes("crs_dep_time").alias("minute"),
        "dep_delay",
    )
    looked_up = windows.last_known_delay(base, ["fl_date", "market"], "minute", "dep_delay", "flight_id")
    return looked_up.select("flight_id", rounded("dep_delay_previous").alias("dep_delay_previous"))


@query(
    "win_row_number_partitioned",
    """SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus
      ORDER BY o_orderdate, o_orderkey) AS row_num FROM orders""",
)
def win_row_number_partitioned(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    numbered = windows.number_rows(orders, ["o_orderstatus"], ["o_orderdate", "o_orderkey"], "row_num")
    return numbered.drop("o_orderdate")


@query(
    "win_parallel_15min",
    f"""WITH {FLIGHTS}, m AS (SELECT flight_id, origin, CAST(floor(epoch(dep_ts) / 60) AS BIGINT) AS minute FROM v_flight)
    SELECT flight_id, count(*) OVER (PARTITION BY origin ORDER BY minute
      RANGE BETWEEN 15 PRECEDING AND 15 FOLLOWING) AS parallel_flights FROM m""",
)
def win_parallel_15min(spark, sf_dir):
    base = flights(spark, sf_dir).select("flight_id", "origin", fx.epoch_minutes("dep_ts").alias("minute"))
    counted = windows.flights_within(base, ["origin"], "minute", "flight_id", 15)
    return counted.select("flight_id", "parallel_flights")


@query(
    "win_tail_sequence",
    f"""WITH {FLIGHTS} SELECT flight_id, row_number() OVER (PARTITION BY tail_num, fl_date
      ORDER BY dep_ts, flight_id) AS tail_num_flight_seq_num FROM v_flight""",
)
def win_tail_sequence(spark, sf_dir):
    base = flights(spark, sf_dir).select("flight_id", "tail_num", "fl_date", "dep_ts")
    numbered = windows.number_rows(
        base, ["tail_num", "fl_date"], ["dep_ts", "flight_id"], "tail_num_flight_seq_num"
    )
    return numbered.select("flight_id", "tail_num_flight_seq_num")


#: The latest delay of the aircraft that is known two hours before a flight.
KNOWN_PRIOR = """flown AS (SELECT tail_num, dep_ts, max(struct_pack(i := flight_id, d := dep_delay)).d AS d
      FROM v_flight GROUP BY tail_num, dep_ts),
    known AS (SELECT f.flight_id, p.d FROM v_flight f ASOF LEFT JOIN flown p
      ON f.tail_num = p.tail_num AND f.dep_ts - INTERVAL 2 HOUR >= p.dep_ts)"""


@query(
    "win_prior_delay",
    f"""WITH {FLIGHTS}, {KNOWN_PRIOR}
    SELECT flight_id, round(CASE WHEN d IS NOT NULL THEN greatest(d, 0) END, 6) AS prior_flight_dep_delay_new FROM known""",
)
def win_prior_delay(spark, sf_dir):
    """Delay of the aircraft's latest flight that is known two hours before departure."""
    base = flights(spark, sf_dir).select("flight_id", "tail_num", "dep_ts", "dep_delay")
    prior = windows.known_prior_delay(base, "tail_num", "dep_ts", "flight_id", "dep_delay")
    return prior.select("flight_id", rounded("prior_flight_dep_delay_new").alias("prior_flight_dep_delay_new"))


@query(
    "win_preceding_delay",
    f"""WITH {FLIGHTS}, p AS (SELECT flight_id, lag(dep_delay) OVER (PARTITION BY tail_num
      ORDER BY dep_ts, flight_id) AS d FROM v_flight)
    SELECT flight_id, round(CASE WHEN d IS NOT NULL THEN greatest(d, 0) END, 6) AS prior_flight_dep_delay_new FROM p""",
)
def win_preceding_delay(spark, sf_dir):
    """Delay of the aircraft's preceding flight, however short before."""
    base = flights(spark, sf_dir).select("flight_id", "tail_num", "dep_ts", "dep_delay")
    prior = windows.prior_delay(base, ["tail_num"], ["dep_ts", "flight_id"], "dep_delay")
    return prior.select("flight_id", rounded("prior_flight_dep_delay_new").alias("prior_flight_dep_delay_new"))


# --- rank of the airport the aircraft comes from ---------------------------------------------------


def _unrolled_ranks() -> str:
    """PageRank of every day's window, step by step."""
    steps = ["""r0 AS MATERIALIZED (SELECT w, id, 1.0 / n AS rank FROM node JOIN size USING (w))"""]
    for i in range(1, STEPS + 1):
        steps.append(
            f"""r{i} AS MATERIALIZED (SELECT n.w, n.id, 0.15 / c.n + 0.85 * (coalesce(d.m, 0) / c.n + coalesce(f.x, 0)) AS rank
            FROM node n JOIN size c ON c.w = n.w
            LEFT JOIN (SELECT r.w, sum(rank) AS m FROM r{i - 1} r ANTI JOIN edge e ON e.w = r.w AND e.src = r.id
              GROUP BY r.w) d ON d.w = n.w
            LEFT JOIN (SELECT e.w, e.dst AS id, sum(r.rank * e.weight / o.out) AS x FROM edge e
              JOIN r{i - 1} r ON e.w = r.w AND e.src = r.id
              JOIN (SELECT w, src, sum(weight) AS out FROM edge GROUP BY w, src) o ON o.w = e.w AND o.src = e.src
              GROUP BY e.w, e.dst) f ON f.w = n.w AND f.id = n.id)"""
        )
    return ",\n".join(steps)


#: ``ranked``: flights with the rank, on their own day, of the airport their aircraft came from.
RANKED = f"""day_of AS MATERIALIZED (SELECT DISTINCT fl_date AS w FROM v_flight),
    edge AS MATERIALIZED (SELECT w, origin AS src, dest AS dst, sum(dep_delay_new) AS weight
      FROM day_of JOIN v_flight ON fl_date < w AND fl_date >= w - INTERVAL {WINDOW_DAYS} DAY
      WHERE dep_delay_new > 0 GROUP BY ALL),
    node AS MATERIALIZED (SELECT w, src AS id FROM edge UNION SELECT w, dst FROM edge),
    size AS MATERIALIZED (SELECT w, count(*) AS n FROM node GROUP BY w),
    {_unrolled_ranks()},
    came AS (SELECT flight_id, fl_date, lag(origin) OVER (PARTITION BY tail_num
      ORDER BY dep_ts, flight_id) AS prior_origin FROM v_flight),
    ranked AS (SELECT flight_id, coalesce(rank, 0) AS delay_rank
      FROM came LEFT JOIN r{STEPS} ON fl_date = w AND prior_origin = id)"""


@query(
    "feat_origin_delay_rank",
    f"""WITH {FLIGHTS}, {RANKED}
    SELECT flight_id, round(delay_rank, 8) AS prior_flight_origin_delay_pagerank FROM ranked""",
)
def feat_origin_delay_rank(spark, sf_dir):
    """Airport PageRank over the delays of the week before a flight's day (no leakage)."""
    base = flights(spark, sf_dir)
    ranks = rolling_airport_ranks(base, "fl_date", "origin", "dest", "dep_delay_new")
    prior = windows.prior_value(
        base.select("flight_id", "tail_num", "dep_ts", "fl_date", "origin"),
        ["tail_num"],
        ["dep_ts", "flight_id"],
        "origin",
        "prior_origin",
    )
    ranked = with_origin_rank(prior, ranks, "fl_date", "prior_origin", "flight_id")
    return ranked.select("flight_id", rounded("prior_flight_origin_delay_pagerank", 8).alias("prior_flight_origin_delay_pagerank"))


@query(
    "feature_table",
    f"""WITH {FLIGHTS}, {KNOWN_PRIOR}, {RANKED},
    day AS (SELECT CAST(unnest(generate_series((SELECT min(fl_date) - INTERVAL 4 DAY FROM v_flight),
      (SELECT max(fl_date) + INTERVAL 4 DAY FROM v_flight), INTERVAL 1 DAY)) AS DATE) AS d),
    holiday AS (SELECT d FROM day WHERE {HOLIDAY_RULES} OR (month(d) = 6 AND day(d) = 19)),
    mark AS (SELECT day.d, max(CASE WHEN day.d = holiday.d THEN 2 ELSE 1 END) AS m
      FROM day JOIN holiday ON abs(date_diff('day', day.d, holiday.d)) <= 3 GROUP BY day.d),
    w AS (SELECT *, CAST(floor(epoch(dep_ts) / 60) AS BIGINT) AS minute,
        d AS prior,
        row_number() OVER (PARTITION BY tail_num, fl_date ORDER BY dep_ts, flight_id) AS seq,
        max(fl_date) OVER () AS latest FROM v_flight JOIN known USING (flight_id) JOIN ranked USING (flight_id))
    SELECT flight_id, {MINUTES} AS crs_dep_time_minutes_from_midnight,
      {sql_rounded(f"sin({HOUR} * (2 * pi() / 24))")} AS crs_dep_hour_sin,
      {sql_rounded(f"cos({HOUR} * (2 * pi() / 24))")} AS crs_dep_hour_cos,
      {sql_rounded("sin(dayofyear(fl_date) * (2 * pi() / 365))")} AS crs_dep_day_of_year_sin,
      {sql_rounded("cos(dayofyear(fl_date) * (2 * pi() / 365))")} AS crs_dep_day_of_year_cos,
      {PART_OF_DAY} AS crs_dep_time_part_of_day, seq AS tail_num_flight_seq_num,
      count(*) OVER (PARTITION BY origin ORDER BY minute RANGE BETWEEN 15 PRECEDING AND 15 FOLLOWING) AS parallel_flights,
      round(CASE WHEN prior IS NOT NULL THEN greatest(prior, 0) END, 6) AS prior_flight_dep_delay_new,
      round(delay_rank, 6) AS prior_flight_origin_delay_pagerank,
      CASE WHEN (month(fl_date) = 12 AND day(fl_date) >= 20) OR (month(fl_date) = 1 AND day(fl_date) <= 10)
        THEN 1 ELSE 0 END AS christmas_travel,
      CAST(coalesce(m, 0) AS INTEGER) AS federal_holiday_indicator,
      CAST(date_diff('day', fl_date, latest) AS INTEGER) AS recency_days
    FROM w LEFT JOIN mark ON fl_date = mark.d""",
)
def feature_table(spark, sf_dir):
    featured = flight_features(flights(spark, sf_dir))
    digits = [c for c in ENGINEERED if c.endswith(("_sin", "_cos", "_delay_new", "_pagerank"))]
    return featured.select("flight_id", *[rounded(c).alias(c) if c in digits else c for c in ENGINEERED])
