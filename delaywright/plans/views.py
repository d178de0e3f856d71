"""Views that give the driver tables the shape of the flight data, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaywright.functions.expressions import clock_hour, delay_flag, positive_part
from delaywright.operators.graph import edges_from
from delaywright.operators.joins import nearest_per_key
from delaywright.operators.skew import join_lookup
from delaywright.operators.splitting import chronological_cuts, label_parts, split_positions
from delaywright.sources.tables import read_parquet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` read as flights: user → aircraft, type → carrier, value → delay."""
    events = table(spark, sf_dir, "events")
    delay = F.col("value") - 35
    return events.select(
        F.col("event_id").alias("flight_id"),
        F.col("ts").alias("dep_ts"),
        F.to_date("ts").alias("fl_date"),
        (F.hour("ts") * 100 + F.minute("ts")).alias("crs_dep_time"),
        F.col("event_type").alias("carrier"),
        F.col("user_id").alias("tail_num"),
        (F.col("user_id") % 20).alias("origin"),
        ((F.col("user_id") * 7 + F.col("event_id")) % 20).alias("dest"),
        delay.alias("dep_delay"),
        positive_part(delay).alias("dep_delay_new"),
        delay_flag(delay, 15).alias("dep_del15"),
    )


FLIGHTS = """
v_flight AS (
  SELECT event_id AS flight_id, ts AS dep_ts, CAST(ts AS DATE) AS fl_date,
    CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS crs_dep_time,
    event_type AS carrier, user_id AS tail_num, user_id % 20 AS origin,
    (user_id * 7 + event_id) % 20 AS dest, value - 35 AS dep_delay,
    CASE WHEN value - 35 > 0 THEN value - 35 ELSE 0 END AS dep_delay_new,
    CASE WHEN value - 35 >= 15 THEN 1 ELSE 0 END AS dep_del15
  FROM events)"""


def with_parts(df: DataFrame) -> DataFrame:
    """Chronological train (80 %) and test parts of the flights."""
    cuts = chronological_cuts(df, "fl_date", "flight_id", split_positions)
    return label_parts(df, "fl_date", "flight_id", cuts, ["train", "test"])


PARTS = (
    FLIGHTS
    + """,
v_pos AS (
  SELECT *, row_number() OVER (ORDER BY fl_date, flight_id) AS pos, count(*) OVER () AS total
  FROM v_flight),
v_part AS (
  SELECT *, CASE WHEN pos <= CAST(floor(total * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS part
  FROM v_pos)"""
)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights with a stand-in prediction: the training mean of their carrier and hour."""
    parts = with_parts(flights(spark, sf_dir)).withColumn("hour", clock_hour("crs_dep_time"))
    means = (
        parts.filter(F.col("part") == "train")
        .groupBy("carrier", "hour")
        .agg(F.avg("dep_delay_new").alias("prediction"))
    )
    return join_lookup(parts, means, ["carrier", "hour"], ["flight_id"]).withColumn(
        "prediction", F.coalesce("prediction", F.lit(0.0))
    )


SCORES = (
    PARTS
    + """,
v_mean AS (
  SELECT carrier, CAST(floor(crs_dep_time / 100) AS INTEGER) AS hour, avg(dep_delay_new) AS m
  FROM v_part WHERE part = 'train' GROUP BY ALL),
v_pred AS (
  SELECT p.*, CAST(floor(p.crs_dep_time / 100) AS INTEGER) AS hour, coalesce(m.m, 0) AS prediction
  FROM v_part p LEFT JOIN v_mean m
    ON p.carrier = m.carrier AND CAST(floor(p.crs_dep_time / 100) AS INTEGER) = m.hour)"""
)


def supply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part → supplier, weighted by order lines. Suppliers have no out-links."""
    lines = table(spark, sf_dir, "lineitem")
    return edges_from(
        lines,
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")),
    )


SUPPLY_EDGES = """
v_edge AS (
  SELECT 'P' || l_partkey AS src, 'S' || l_suppkey AS dst, count(*) AS weight
  FROM lineitem GROUP BY ALL)"""


def trade_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer nation → supplier nation, weighted by order lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return edges_from(joined, F.col("c_nationkey"), F.col("s_nationkey"))


TRADE_EDGES = """
v_trade AS (
  SELECT c_nationkey AS src, s_nationkey AS dst, count(*) AS weight
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY ALL)"""


def station_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport → its nearest station and the distance."""
    pairs = trade_edges(spark, sf_dir).select(
        F.col("src").cast("bigint").alias("origin"),
        F.col("dst").cast("bigint").alias("station"),
        F.col("weight").cast("double").alias("station_distance"),
    )
    return nearest_per_key(pairs, "origin", "station", "station_distance")


def station_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather reports: the ``error`` events (all events are flights)."""
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "error")
        .select(
            F.col("event_id").alias("report_id"),
            F.col("ts").alias("report_ts"),
            (F.col("user_id") % 25).alias("station"),
            F.col("value").alias("reading"),
        )
    )


#: ``v_weather``: flights with the latest report of their station two hours before departure.
WEATHER = (
    TRADE_EDGES
    + """,
v_station AS (SELECT src AS origin, min(struct_pack(d := weight, s := dst)) AS best FROM v_trade GROUP BY src),
v_report AS (SELECT event_id AS report_id, ts AS report_ts, user_id % 25 AS station, value AS reading
  FROM events WHERE event_type = 'error'),
v_placed AS (SELECT v.flight_id, v.origin, v.dep_ts, n.best.s AS station
  FROM v_flight v LEFT JOIN v_station n ON v.origin = n.origin),
v_weather AS (SELECT f.flight_id, f.origin, CAST(f.station AS BIGINT) AS station, r.report_id, r.reading
  FROM v_placed f ASOF LEFT JOIN v_report r ON f.station = r.station AND f.dep_ts - INTERVAL 2 HOUR >= r.report_ts)"""
)


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels; most label values are missing."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")


LABELLED = """
v_doc AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def iso(column: str | Column) -> Column:
    """Dates leave a query as text, which every client reads the same way."""
    return F.date_format(column, "yyyy-MM-dd")


def rounded(column: str | Column, digits: int = 6) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value, digits)


def sql_rounded(expression: str, digits: int = 6) -> str:
    """Rounded, with minus zero as zero."""
    return f"CASE WHEN round({expression}, {digits}) = 0 THEN 0.0 ELSE round({expression}, {digits}) END"
