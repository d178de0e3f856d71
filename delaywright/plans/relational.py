"""Sources, projections, filters, joins, aggregates, set operations, sorts and samples."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from delaywright.functions import expressions as fx
from delaywright.operators import cleaning, joins, profiling, sketches, summaries
from delaywright.plans.registry import query
from delaywright.plans.views import (
    FLIGHTS,
    LABELLED,
    PARTS,
    SUPPLY_EDGES,
    TRADE_EDGES,
    WEATHER,
    flights,
    iso,
    labelled_documents,
    rounded,
    supply_edges,
    station_lookup,
    station_reports,
    table,
    trade_edges,
    with_parts,
)
from delaywright.runtime import scratch_path, spool
from delaywright.sources import adjacency, tables

ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)

# --- sources and sinks -----------------------------------------------------------------------


@query(
    "scan_parquet",
    "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders",
)
def scan_parquet(spark, sf_dir):
    return tables.read_parquet(spark, f"{sf_dir}/orders.parquet", ORDERS_SCHEMA).withColumn("o_orderdate", iso("o_orderdate"))


@query(
    "scan_glob",
    """SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer""",
)
def scan_glob(spark, sf_dir):
    root = scratch_path(spark, "parties")
    for name, p in (("supplier", "s_suppkey s_name s_acctbal"), ("customer", "c_custkey c_name c_acctbal")):
        key, label, balance = p.split()
        part = table(spark, sf_dir, name).select(
            F.col(key).alias("id"), F.col(label).alias("name"), F.col(balance).alias("balance")
        )
        tables.write_parquet(part, f"{root}/{name}")
    return tables.read_parquet_glob(spark, f"{root}/*", "id bigint, name string, balance double")


@query(
    "scan_csv_roundtrip",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def scan_csv_roundtrip(spark, sf_dir):
    source = table(spark, sf_dir, "customer")
    path = tables.write_csv(source, scratch_path(spark, "customer-csv"))
    return cleaning.cast_columns(tables.read_csv(spark, path, source.columns), source.schema)


@query("scan_adjacency_text", f"WITH {SUPPLY_EDGES} SELECT src, dst, weight FROM v_edge")
def scan_adjacency_text(spark, sf_dir):
    path = adjacency.write_adjacency(supply_edges(spark, sf_dir), scratch_path(spark, "adjacency"))
    return adjacency.read_adjacency(spark, path)


@query(
    "roundtrip_count_max",
    "SELECT count(*) AS row_count, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS max_date FROM events",
)
def roundtrip_count_max(spark, sf_dir):
    path = tables.write_parquet(
        table(spark, sf_dir, "events"), scratch_path(spark, "events"), ["event_type"]
    )
    return tables.load_report(tables.read_parquet(spark, path), "ts")


@query(
    "inline_rows",
    """SELECT v.label, count(*) AS lines, round(sum(l_extendedprice * v.factor), 2) AS weighted
    FROM lineitem JOIN (VALUES ('A', 'accepted', 1.0), ('N', 'new', 0.5), ('R', 'returned', 0.25))
      AS v(flag, label, factor) ON l_returnflag = v.flag
    GROUP BY v.label""",
)
def inline_rows(spark, sf_dir):
    rates = tables.local_rows(
        spark,
        [("A", "accepted", 1.0), ("N", "new", 0.5), ("R", "returned", 0.25)],
        "flag string, label string, factor double",
    )
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    # sum per flag first: only three rows meet the inline table
    per_flag = lines.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_extendedprice").alias("total")
    )
    return per_flag.join(rates, per_flag["l_returnflag"] == rates["flag"]).select(
        "label", "lines", F.round(F.col("total") * F.col("factor"), 2).alias("weighted")
    )


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "estimate_size",
    "WITH t AS (SELECT CAST(sum("
    + " + ".join(f"length(CAST({c} AS VARCHAR)) + 1" for c in ORDER_COLUMNS)
    + """) AS BIGINT) AS b FROM orders)
    , m AS (SELECT count(DISTINCT strftime(o_orderdate, '%Y-%m')) AS n FROM orders)
    SELECT b AS text_bytes, round(b / 1073741824.0, 9) AS size_gib, round(b / 1073741824.0 * (72.0 / n), 9) AS projected_gib
    FROM t, m""",
)
def estimate_size(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    size = tables.size_estimate(orders, "o_orderdate", months_wanted=72)
    return size.select(
        "text_bytes", rounded("size_gib", 9).alias("size_gib"), rounded("projected_gib", 9).alias("projected_gib")
    )


@query(
    "schema_rows",
    """SELECT 'event_id' AS name, 'bigint' AS type, 0 AS position, count(*) - count(event_id) AS nulls FROM events
    UNION ALL SELECT 'event_type', 'string', 3, count(*) - count(event_type) FROM events
    UNION ALL SELECT 'value', 'double', 4, count(*) - count(value) FROM events""",
)
def schema_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    listed = tables.schema_rows(events, keep=["event_id", "event_type", "value"])
    profile = profiling.null_profile(events)
    return listed.join(profile, listed["name"] == profile["column"]).select(
        "name", "type", "position", "nulls"
    )


# --- projections and casts ---------------------------------------------------------------------


@query("project_cols", "SELECT o_orderkey, o_totalprice FROM orders")
def project_cols(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")


KNOWN_BEFORE = ["flight_id", "carrier", "tail_num", "origin", "dest", "crs_dep_time", "distance", "dep_delay"]


@query(
    "project_known_before",
    f"WITH {FLIGHTS} SELECT flight_id, carrier, tail_num, origin, dest, crs_dep_time, dep_delay FROM v_flight",
)
def project_known_before(spark, sf_dir):
    return cleaning.keep_known(flights(spark, sf_dir), KNOWN_BEFORE)


@query(
    "cast_typed",
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity,
      CAST(l_suppkey AS VARCHAR) AS l_suppkey FROM lineitem""",
)
def cast_typed(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_suppkey")
    return cleaning.cast_columns(lines, {"l_quantity": "int", "l_suppkey": "string"})


@query(
    "cast_schema",
    "SELECT CAST(event_id AS INTEGER) AS event_id, CAST(user_id AS DOUBLE) AS user_id, event_type, value FROM events",
)
def cast_schema(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    text = events.select(*[F.col(c).cast("string").alias(c) for c in events.columns])
    wanted = StructType(
        [
            StructField("event_id", IntegerType()),
            StructField("user_id", DoubleType()),
            StructField("event_type", StringType()),
            StructField("value", DoubleType()),
        ]
    )
    return cleaning.cast_columns(text, wanted)


@query(
    "cast_date",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(dayofyear(ts) AS INTEGER) AS doy,
      strftime(ts, '%Y-%m-%d') AS fl_date FROM events""",
)
def cast_date(spark, sf_dir):
    text = table(spark, sf_dir, "events").select("event_id", iso("ts").alias("fl_date"))
    dated = cleaning.cast_dates(text, ["fl_date"])
    return dated.select(
        "event_id",
        F.year("fl_date").alias("y"),
        F.dayofyear("fl_date").alias("doy"),
        iso("fl_date").alias("fl_date"),
    )


@query(
    "clean_weather_number",
    """SELECT l_orderkey, l_linenumber, l_extendedprice,
      CASE WHEN l_returnflag = 'R' THEN 0.005 WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN NULL
           ELSE l_quantity END AS reading
    FROM lineitem""",
)
def clean_weather_number(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity").cast("string")
    dirty = (
        F.when(F.col("l_returnflag") == "R", F.lit("T"))
        .when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"), F.lit("VRB"))
        .when(F.col("l_linestatus") == "O", F.concat(quantity, F.lit("s")))
        .otherwise(F.concat(F.lit(" "), quantity))
    )
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        fx.weather_number(dirty, trace_value=0.005).alias("reading"),
    )


# --- filters ------------------------------------------------------------------------------------


@query(
    "filter_target_known",
    f"WITH {LABELLED} SELECT doc_id, quality, toxic FROM v_doc WHERE quality IS NOT NULL",
)
def filter_target_known(spark, sf_dir):
    known = cleaning.with_known_target(labelled_documents(spark, sf_dir), "quality")
    return known.select("doc_id", "quality", "toxic")


@query(
    "filter_domestic",
    f"""WITH {TRADE_EDGES} SELECT src, dst, weight FROM v_trade
    WHERE src IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 3))
      AND dst IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 3))""",
)
def filter_domestic(spark, sf_dir):
    home = table(spark, sf_dir, "nation").filter(F.col("n_regionkey").isin(1, 3)).select("n_nationkey")
    return cleaning.within_country(trade_edges(spark, sf_dir), "src", "dst", home)


@query(
    "filter_sane_range",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice < 20000",
)
def filter_sane_range(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return cleaning.below(lines, "l_extendedprice", 20000)


@query("filter_since", "SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def filter_since(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    bound = F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    return events.filter(F.col("ts") >= bound).select("event_id", "value")


@query(
    "filter_trailing_days",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders
    WHERE o_orderdate >= (SELECT CAST(max(o_orderdate) AS DATE) - 730 FROM orders)""",
)
def filter_trailing_days(spark, sf_dir):
    recent = cleaning.trailing_days(table(spark, sf_dir, "orders"), "o_orderdate", 730)
    return recent.select("o_orderkey", iso("o_orderdate").alias("order_day"))


@query(
    "filter_not_cancelled",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'",
)
def filter_not_cancelled(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.filter(F.col("o_orderstatus") != "P").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )


# --- joins -----------------------------------------------------------------------------------------


@query(
    "join_share_of_group",
    """SELECT l_returnflag, l_linestatus, n, total, round(n * 100.0 / total, 6) AS percentage
    FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL) c
      JOIN (SELECT l_returnflag, count(*) AS total FROM lineitem GROUP BY ALL) t USING (l_returnflag)""",
)
def join_share_of_group(spark, sf_dir):
    shares = summaries.share_within(table(spark, sf_dir, "lineitem"), ["l_returnflag"], ["l_linestatus"])
    return shares.withColumn("percentage", rounded("percentage"))


@query(
    "asof_join_prior_event",
    f"""WITH {FLIGHTS},
    report AS (SELECT event_id AS report_id, ts AS report_ts, CASE WHEN event_id % 89 <> 0 THEN user_id % 20 END AS station,
        value AS reading FROM events WHERE event_type = 'error')
    SELECT f.flight_id, f.origin, r.report_id, r.reading
    FROM (SELECT flight_id, dep_ts, CASE WHEN flight_id % 97 <> 0 THEN origin END AS origin FROM v_flight) f
    ASOF LEFT JOIN report r
      ON f.origin = r.station AND f.dep_ts - INTERVAL 2 HOUR >= r.report_ts""",
)
def asof_join_prior_event(spark, sf_dir):
    """Latest error event (as a stand-in for a weather report) two hours before departure. Some
    flights and some reports have no known airport: they match nothing."""
    left = flights(spark, sf_dir).select(
        "flight_id", F.when(F.col("flight_id") % 97 != 0, F.col("origin")).alias("origin"), "dep_ts"
    )
    reports = (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "error")
        .select(
            F.col("event_id").alias("report_id"),
            F.col("ts").alias("report_ts"),
            F.when(F.col("event_id") % 89 != 0, F.col("user_id") % 20).alias("origin"),
            F.col("value").alias("reading"),
        )
    )
    cut_off = F.col("dep_ts") - F.expr("INTERVAL 2 HOURS")
    return joins.asof_join(
        left, reports, ["origin"], cut_off, "report_ts", "flight_id", "report_id", ["report_id", "reading"]
    ).drop("dep_ts")


@query(
    "nearest_neighbor_lookup",
    """SELECT s_suppkey, min(c_custkey) AS c_custkey, round(gap, 6) AS gap
    FROM (SELECT s_suppkey, c_custkey, abs(c_acctbal - s_acctbal) AS gap,
            min(abs(c_acctbal - s_acctbal)) OVER (PARTITION BY s_suppkey) AS best
          FROM supplier JOIN customer ON s_nationkey = c_nationkey)
    WHERE gap = best GROUP BY s_suppkey, gap""",
)
def nearest_neighbor_lookup(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), "s_acctbal")
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), "c_acctbal")
    found = joins.nearest_by_value(
        suppliers, customers, ["nation"], "s_acctbal", "c_acctbal", "s_suppkey", "c_custkey"
    )
    return found.filter(F.col("c_custkey").isNotNull()).select("s_suppkey", "c_custkey", rounded("gap").alias("gap"))


@query(
    "nearest_station_pairs",
    """WITH best AS (SELECT l_partkey, min(struct_pack(d := l_extendedprice, s := l_suppkey)) AS b
      FROM lineitem GROUP BY l_partkey)
    SELECT l_partkey, b.s AS l_suppkey, b.d AS l_extendedprice, s_name
    FROM best LEFT JOIN supplier ON b.s = s_suppkey""",
)
def nearest_station_pairs(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice")
    nearest = joins.nearest_per_key(pairs, "l_partkey", "l_suppkey", "l_extendedprice")
    stations = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return nearest.join(stations, nearest["l_suppkey"] == stations["s_suppkey"], "left").drop("s_suppkey")


@query(
    "flight_weather_join",
    f"WITH {FLIGHTS}, {WEATHER} SELECT flight_id, origin, station, report_id, reading FROM v_weather",
)
def flight_weather_join(spark, sf_dir):
    """Flights → nearest station → latest report at least two hours before departure. The reports
    are the ``error`` events; all events are flights."""
    base = flights(spark, sf_dir).select("flight_id", "origin", "dep_ts")
    reports = station_reports(spark, sf_dir)
    stations = station_lookup(spark, sf_dir).drop("station_distance")
    found = joins.with_station_reports(
        base, stations, reports, "origin", "dep_ts", "flight_id", "station", "report_ts", "report_id", ["report_id", "reading"]
    )
    return found.drop("dep_ts")


# --- aggregates --------------------------------------------------------------------------------------


@query("count_rows", "SELECT count(*) AS n FROM lineitem")
def count_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("count_by_group", "SELECT o_orderpriority, count(*) AS orders FROM orders GROUP BY 1")
def count_by_group(spark, sf_dir):
    counted = summaries.count_by(table(spark, sf_dir, "orders"), "o_orderpriority", name="orders")
    return counted.orderBy(F.desc("orders"), "o_orderpriority")


@query(
    "avg_by_group",
    """SELECT l_returnflag, round(avg(l_quantity), 6) AS avg_l_quantity,
      round(avg(l_extendedprice), 4) AS avg_l_extendedprice, round(avg(l_discount), 6) AS avg_l_discount
    FROM lineitem GROUP BY 1""",
)
def avg_by_group(spark, sf_dir):
    averaged = summaries.averages_by(
        table(spark, sf_dir, "lineitem"), ["l_returnflag"], ["l_quantity", "l_extendedprice", "l_discount"]
    )
    return averaged.select(
        "l_returnflag",
        rounded("avg_l_quantity").alias("avg_l_quantity"),
        rounded("avg_l_extendedprice", 4).alias("avg_l_extendedprice"),
        rounded("avg_l_discount").alias("avg_l_discount"),
    ).orderBy("l_returnflag")


@query(
    "summary_by_group",
    f"""WITH {FLIGHTS} SELECT origin, count(dep_delay) AS n, round(avg(dep_delay), 6) AS mean,
      round(stddev_samp(dep_delay), 6) AS stddev, round(min(dep_delay), 6) AS min,
      round(max(dep_delay), 6) AS max FROM v_flight GROUP BY 1""",
)
def summary_by_group(spark, sf_dir):
    summary = summaries.summary_by(flights(spark, sf_dir), ["origin"], "dep_delay")
    return summary.select("origin", "n", *[rounded(c).alias(c) for c in ("mean", "stddev", "min", "max")])


@query(
    "avg_by_calendar_part",
    f"""WITH {FLIGHTS}, long AS (
      SELECT 'day_of_month' AS part, CAST(day(fl_date) AS INTEGER) AS value, dep_delay FROM v_flight
      UNION ALL SELECT 'day_of_week', CAST(isodow(fl_date) AS INTEGER), dep_delay FROM v_flight
      UNION ALL SELECT 'month', CAST(month(fl_date) AS INTEGER), dep_delay FROM v_flight
      UNION ALL SELECT 'hour', CAST(floor(crs_dep_time / 100) AS INTEGER), dep_delay FROM v_flight)
    SELECT part, value, round(avg(dep_delay), 6) AS average, count(dep_delay) AS n FROM long GROUP BY 1, 2""",
)
def avg_by_calendar_part(spark, sf_dir):
    parts = {
        "day_of_month": F.dayofmonth("fl_date"),
        "day_of_week": fx.day_of_week("fl_date"),
        "month": F.month("fl_date"),
        "hour": fx.clock_hour("crs_dep_time"),
    }
    averaged = summaries.calendar_averages(flights(spark, sf_dir), parts, "dep_delay")
    return averaged.withColumn("average", rounded("average"))


@query(
    "daily_counts",
    "SELECT strftime(ts, '%Y-%m-%d') AS fl_date, count(*) AS flights FROM events GROUP BY 1",
)
def daily_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return summaries.count_by(events, iso("ts").alias("fl_date")).orderBy("fl_date")


@query(
    "pivot_daily_by_year",
    """WITH d AS (SELECT DISTINCT strftime(o_orderdate, '%m-%d') AS month_day FROM orders),
    y AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
    n AS (SELECT strftime(o_orderdate, '%m-%d') AS month_day, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY ALL)
    SELECT month_day, string_agg(coalesce(n, 0), ',' ORDER BY y) AS counts
    FROM d CROSS JOIN y LEFT JOIN n USING (month_day, y) GROUP BY month_day""",
)
def pivot_daily_by_year(spark, sf_dir):
    """Orders of every calendar day; one place in the list for each year of the data, ascending."""
    listed = summaries.daily_counts_by_year(table(spark, sf_dir, "orders"), "o_orderdate")
    return listed.withColumn("counts", F.array_join(F.col("counts").cast("array<string>"), ","))


@query(
    "delay_ratio_by_group",
    f"""WITH {FLIGHTS} SELECT origin, CAST(isodow(fl_date) AS INTEGER) AS day_of_week,
      count(*) FILTER (dep_delay > 0) AS hits, count(*) AS rows,
      round(count(*) FILTER (dep_delay > 0) / count(*), 6) AS delay_ratio
    FROM v_flight GROUP BY 1, 2""",
)
def delay_ratio_by_group(spark, sf_dir):
    dated = flights(spark, sf_dir).withColumn("day_of_week", fx.day_of_week("fl_date"))
    late = cleaning.flag(F.col("dep_delay") > 0)
    ratios = summaries.ratio_by(dated, ["origin", "day_of_week"], late, "delay_ratio")
    return ratios.withColumn("delay_ratio", rounded("delay_ratio")).orderBy("origin", "day_of_week")


@query(
    "share_within_group",
    f"""WITH {FLIGHTS}, p AS (SELECT CASE WHEN crs_dep_time >= 500 AND crs_dep_time < 1200 THEN 'Morning'
        WHEN crs_dep_time >= 1200 AND crs_dep_time < 1800 THEN 'Afternoon' ELSE 'Night' END AS part_of_day,
        dep_del15 FROM v_flight)
    SELECT part_of_day, dep_del15, count(*) AS n,
      CAST(sum(count(*)) OVER (PARTITION BY part_of_day) AS BIGINT) AS total,
      round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY part_of_day), 6) AS percentage
    FROM p GROUP BY part_of_day, dep_del15""",
)
def share_within_group(spark, sf_dir):
    parts = flights(spark, sf_dir).withColumn("part_of_day", fx.part_of_day("crs_dep_time"))
    shares = summaries.share_within(parts, ["part_of_day"], ["dep_del15"])
    return shares.withColumn("percentage", rounded("percentage"))


@query("distinct_count", "SELECT count(DISTINCT o_custkey) AS customers FROM orders")
def distinct_count(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(F.count_distinct("o_custkey").alias("customers"))


@query(
    "distinct_count_sketched",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, o_custkey FROM orders)
    SELECT 'year ' || year(day) AS span, count(DISTINCT o_custkey) AS exact, true AS within_bound FROM d GROUP BY year(day)
    UNION ALL SELECT 'all', count(DISTINCT o_custkey), true FROM d""",
)
def distinct_count_sketched(spark, sf_dir):
    """Customers by year and in all from one table of daily sketches, held against exact counts."""
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), "o_custkey")
    daily = spool(sketches.sketch_by(orders, ["day"], "o_custkey"), "sketches")
    year = F.concat(F.lit("year "), F.year("day"))
    unions = sketches.estimate(daily.withColumn("span", year), ["span"]).unionByName(
        sketches.estimate(daily.withColumn("span", F.lit("all")), ["span"])
    )
    spans = F.explode(F.array(year, F.lit("all"))).alias("span")
    exact = orders.select(spans, "o_custkey").groupBy("span").agg(F.count_distinct("o_custkey").alias("exact"))
    off = F.abs(F.col("estimate") - F.col("exact"))
    bound = F.greatest(F.lit(1.0), sketches.relative_error() * F.col("exact"))
    return exact.join(unions, "span").select("span", "exact", (off <= bound).alias("within_bound"))


@query("distinct_values", f"WITH {SUPPLY_EDGES} SELECT DISTINCT dst AS id FROM v_edge")
def distinct_values(spark, sf_dir):
    return supply_edges(spark, sf_dir).select(F.col("dst").alias("id")).distinct()


@query(
    "date_range",
    f"""WITH {PARTS} SELECT part, strftime(min(fl_date), '%Y-%m-%d') AS first_day,
      strftime(max(fl_date), '%Y-%m-%d') AS last_day FROM v_part GROUP BY part""",
)
def date_range(spark, sf_dir):
    parts = with_parts(flights(spark, sf_dir))
    return parts.groupBy("part").agg(
        iso(F.min("fl_date")).alias("first_day"), iso(F.max("fl_date")).alias("last_day")
    )


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_keys(spark, sf_dir):
    return cleaning.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dedupe_keys",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_extendedprice, l_partkey, l_suppkey) = 1""",
)
def dedupe_keys(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey"
    )
    return cleaning.first_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_extendedprice"])


# --- sorts, top-k, samples, set operations -------------------------------------------------------------


@query("sort_multi", "SELECT o_orderstatus, o_totalprice, o_orderkey FROM orders")
def sort_multi(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_totalprice", "o_orderkey")
    return orders.orderBy("o_orderstatus", F.desc("o_totalprice"), "o_orderkey")


@query(
    "limit_ordered",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def limit_ordered(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query(
    "sample_hash_mod",
    "SELECT event_id, value FROM events WHERE substr(md5(CAST(event_id AS VARCHAR)), 1, 8) < '33333333'",
)
def sample_hash_mod(spark, sf_dir):
    return profiling.keyed_sample(table(spark, sf_dir, "events").select("event_id", "value"), "event_id", 0.2)


@query("sample")
def sample(spark, sf_dir):
    return profiling.bernoulli_sample(table(spark, sf_dir, "events").select("event_id", "value"), 0.2, 42)


@query(
    "sample_fixed_size",
    f"""WITH {SUPPLY_EDGES} SELECT src, dst, weight FROM v_edge
    ORDER BY md5('42:' || src || ':' || dst), src, dst LIMIT 1000""",
)
def sample_fixed_size(spark, sf_dir):
    return profiling.fixed_size_sample(supply_edges(spark, sf_dir), 1000, 42, ["src", "dst"])


@query(
    "union_tagged",
    """SELECT o_orderkey, 'early' AS part, false AS is_validation FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
    UNION ALL SELECT o_orderkey, 'late', true FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'""",
)
def union_tagged(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    bound = F.to_timestamp_ntz(F.lit("1999-01-01 00:00:00"))
    early = orders.filter(F.col("o_orderdate") < bound).select("o_orderkey")
    late = orders.filter(F.col("o_orderdate") >= bound).select("o_orderkey")
    tagged = cleaning.tagged_union({"early": early, "late": late}, "part")
    return tagged.withColumn("is_validation", F.col("part") == "late")


@query(
    "except_keys",
    """SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'
    EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'""",
)
def except_keys(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    returned, accepted = (lines.filter(F.col("l_returnflag") == f) for f in ("R", "A"))
    return cleaning.keys_without_match(returned, accepted, ["l_partkey", "l_suppkey"])
