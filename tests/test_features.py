"""Scalar features, cleaning and sources."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from delaywright.functions import expressions as fx
from delaywright.operators import cleaning, summaries, windows
from delaywright.sources import tables
from tests.conftest import plan_text, rows_of


def values(spark, rows, ddl, column):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(column).collect()]


def test_clock_fields(spark):
    clocks = [(5,), (459,), (500,), (1159,), (1345,), (1800,), (2359,)]
    assert values(spark, clocks, "c int", fx.clock_hour("c")) == [0, 4, 5, 11, 13, 18, 23]
    assert values(spark, clocks, "c int", fx.clock_minutes("c")) == [5, 299, 300, 719, 825, 1080, 1439]
    assert values(spark, [(0,), (2300,)], "c int", fx.minutes_until_midnight("c")) == [1440, 60]
    parts = values(spark, clocks + [(None,)], "c int", fx.part_of_day("c"))
    assert parts == ["Night", "Night", "Morning", "Morning", "Afternoon", "Night", "Night", None]
    codes = values(spark, [("Morning",), ("Afternoon",), ("Night",), ("?",)], "p string", fx.part_of_day_code("p"))
    assert codes == [1, 2, 3, None]


def test_delay_classes_leave_unknown_unknown(spark):
    rows = [(-3.0,), (0.0,), (15.0,), (15.5,), (61.0,), (None,)]
    assert values(spark, rows, "d double", fx.status_bucket("d")) == [
        "On Time", "On Time", "Small Delay", "Large Delay", "Large Delay", None,
    ]
    assert values(spark, rows, "d double", fx.delay_flag("d", 15)) == [0, 0, 1, 1, 1, None]
    assert values(spark, rows, "d double", fx.delay_flag("d", 60, inclusive=False)) == [0, 0, 0, 0, 1, None]
    assert values(spark, rows, "d double", fx.positive_part("d")) == [0.0, 0.0, 15.0, 15.5, 61.0, None]


def test_cyclic_wraps(spark):
    sin, cos = fx.cyclic("h", 24)
    rows = spark.createDataFrame([(0,), (6,), (24,)], "h int").select(sin.alias("s"), cos.alias("c")).collect()
    assert rows[0]["s"] == pytest.approx(rows[2]["s"], abs=1e-12)
    assert (rows[1]["s"], rows[1]["c"]) == pytest.approx((1.0, math.cos(math.pi / 2)))


def test_christmas_window(spark):
    days = [(dt.date(2015, 12, 19),), (dt.date(2015, 12, 20),), (dt.date(2016, 1, 10),), (dt.date(2016, 1, 11),)]
    assert values(spark, days, "d date", fx.christmas_travel("d")) == [0, 1, 1, 0]


def test_federal_holidays(spark):
    found = {r["holiday"] for r in fx.federal_holidays(spark, 2019, 2021).collect()}
    assert {dt.date(2019, 11, 28), dt.date(2019, 5, 27), dt.date(2020, 9, 7), dt.date(2021, 6, 19)} <= found
    assert dt.date(2019, 6, 19) not in found
    assert len([d for d in found if d.year == 2019]) == 10


def test_holiday_overlap_takes_the_maximum(spark):
    days = spark.createDataFrame(
        [(dt.date(2019, 12, 31),), (dt.date(2020, 1, 1),), (dt.date(2019, 12, 25),), (dt.date(2019, 8, 1),)], "d date"
    )
    marked = fx.with_holiday_indicator(days, "d")
    assert dict(marked.select("d", "federal_holiday_indicator").collect()) == {
        dt.date(2019, 12, 31): 1, dt.date(2020, 1, 1): 2, dt.date(2019, 12, 25): 2, dt.date(2019, 8, 1): 0,
    }


def test_recency_depends_on_a_parameter(spark):
    age = values(spark, [(dt.date(2020, 1, 1),)], "d date", fx.recency_days("d", dt.date(2020, 3, 1)))
    assert age == [60]


def test_weather_numbers(spark):
    rows = [("0.05",), ("T",), ("12s",), (" 7 ",), ("-3.5V",), ("VRB",), ("",), (None,), ("1 2",), (".5",)]
    assert values(spark, rows, "w string", fx.weather_number("w")) == [
        0.05, None, 12.0, 7.0, -3.5, None, None, None, None, 0.5,
    ]
    assert values(spark, [("T",)], "w string", fx.weather_number("w", trace_value=0.005)) == [0.005]


def test_casts_never_raise(spark):
    df = spark.createDataFrame([("1", "x", "2015-01-31"), ("a", "2.5", "31/01/2015")], "i string, d string, t string")
    typed = cleaning.cast_dates(cleaning.cast_columns(df, {"i": "int", "d": "double"}), ["t"])
    assert typed.collect() == [(1, None, dt.date(2015, 1, 31)), (None, 2.5, None)]


def test_bulk_cast_is_one_projection(spark):
    df = spark.range(3).select(*[F.col("id").cast("string").alias(f"c{i}") for i in range(20)])
    plan = cleaning.cast_columns(df, {f"c{i}": "int" for i in range(20)})._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 2


def test_domestic_filter_list_and_table_agree(spark):
    df = spark.createDataFrame([("CA", "NY"), ("CA", "XX"), (None, "NY")], "o string, d string")
    states = spark.createDataFrame([(s,) for s in cleaning.US_STATES] * 2, "code string")
    assert rows_of(cleaning.within_country(df, "o", "d")) == [("CA", "NY")]
    assert rows_of(cleaning.within_country(df, "o", "d", states)) == [("CA", "NY")]
    assert len(set(cleaning.US_STATES)) == len(cleaning.US_STATES) == 56


def test_sane_range_drops_unreadable(spark):
    df = spark.createDataFrame([("10",), ("2500",), ("VRB",), (None,)], "w string")
    assert rows_of(cleaning.below(df, "w", 2000)) == [("10",)]


def test_trailing_days_is_a_pushed_subquery(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    recent = cleaning.trailing_days(orders, "o_orderdate", 730)
    latest = orders.agg(F.max("o_orderdate")).first()[0]
    assert recent.agg(F.min("o_orderdate")).first()[0] >= latest - dt.timedelta(days=730)
    text = plan_text(recent)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_first_per_key_is_order_free(spark):
    rows = [(1, 5.0, "b"), (1, 5.0, "a"), (1, 7.0, "c"), (2, None, "d"), (2, 1.0, "e")]
    df = spark.createDataFrame(rows, "k int, v double, s string")
    kept = rows_of(cleaning.first_per_key(df.repartition(5), ["k"], ["v"]))
    assert kept == [(1, 5.0, "a"), (2, None, "d")]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "a int, b int")
    assert rows_of(cleaning.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]


def test_share_join_equals_window_form(spark):
    from pyspark.sql import Window

    df = spark.range(500).select((F.col("id") % 7).alias("g"), (F.col("id") % 3).alias("c"))
    df = df.unionByName(spark.createDataFrame([(None, 1), (None, 2)], "g bigint, c bigint"))
    counts = df.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n"))
    window = counts.withColumn("total", F.sum("n").over(Window.partitionBy("g")))
    expected = window.select("g", "c", "n", "total", (F.col("n") / F.col("total") * 100).alias("percentage"))
    assert rows_of(summaries.share_within(df, ["g"], ["c"])) == rows_of(expected)


def test_pivot_keeps_leap_day(spark):
    rows = [(dt.date(2016, 2, 29),), (dt.date(2016, 2, 29),), (dt.date(2015, 3, 1),)]
    df = spark.createDataFrame(rows, "d date")
    assert rows_of(summaries.daily_by_year(df, "d", [2015, 2016])) == [("02-29", 0, 2), ("03-01", 1, 0)]


def test_pivot_takes_its_years_from_the_data(spark):
    df = spark.createDataFrame([(dt.date(1980, 3, 1),), (dt.date(2040, 3, 1),), (None,)], "d date")
    wide = summaries.daily_by_year(df, "d")
    assert wide.columns == ["month_day", "y1980", "y2040"] and rows_of(wide) == [("03-01", 1, 1)]
    with pytest.raises(ValueError, match="1980"):
        summaries.daily_by_year(df, "d", [2040])


def test_holidays_of_any_year_equal_the_calendar(spark):
    days = spark.sql("SELECT explode(sequence(date'1899-12-01', date'2101-02-01', interval 1 day)) AS d")
    marked = fx.with_holiday_indicator(days, "d")
    calendar = fx.federal_holidays(spark, 1898, 2102)
    near = calendar.selectExpr("holiday", "explode(sequence(date_sub(holiday, 3), date_add(holiday, 3))) AS d")
    want = near.groupBy("d").agg(F.max(F.when(F.col("d") == F.col("holiday"), 2).otherwise(1)).alias("w"))
    wrong = marked.join(want, "d", "left").filter("federal_holiday_indicator <> coalesce(w, 0)")
    assert wrong.count() == 0
    unknown = spark.createDataFrame([(None,)], "d date")
    assert fx.with_holiday_indicator(unknown, "d").first()[1] == 0


def test_flights_within_more_than_a_day(spark):
    rows = [(i, "A", m) for i, m in enumerate([0, 1500, 3000, 4500, None])]
    df = spark.createDataFrame(rows, "id int, g string, m bigint")
    found = windows.flights_within(df, ["g"], "m", "id", 4000)
    assert dict(rows_of(found, "id", "parallel_flights")) == {0: 3, 1: 4, 2: 4, 3: 3, 4: None}


def test_size_estimate_counts_the_months(spark):
    df = spark.createDataFrame([("ab", dt.date(2020, 1, 5)), ("c", dt.date(2020, 3, 1)), ("d", dt.date(2020, 3, 9))], "t string, d date")
    row = tables.size_estimate(df, "d", 12).first()
    assert row["text_bytes"] == 4 + 3 + 33 and abs(row["projected_gib"] / row["size_gib"] - 6) < 1e-9


def test_csv_is_text_until_cast(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "n int, s string")
    path = tables.write_csv(df, str(tmp_path / "csv"))
    assert [t for _, t in tables.read_csv(spark, path).dtypes] == ["string", "string"]
    assert rows_of(tables.read_csv(spark, path, ["n", "s"])) == [("1", "a,b"), ("2", None)]


def test_partitioned_write_prunes(spark, tmp_path):
    df = spark.range(100).withColumn("day", F.col("id") % 5)
    path = tables.write_parquet(df, str(tmp_path / "p"), ["day"])
    scan = tables.read_parquet(spark, path).filter("day = 3")
    assert scan.count() == 20
    assert "PartitionFilters: [isnotnull(day" in plan_text(scan)


def test_empty_frame_keeps_its_schema(spark):
    empty = tables.local_rows(spark, [], "column string, q1 double")
    assert empty.count() == 0 and empty.columns == ["column", "q1"]


def test_known_before_ignores_missing_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "arr_delay int, origin int, carrier int")
    assert cleaning.keep_known(df, ["carrier", "distance", "origin"]).columns == ["carrier", "origin"]


def test_tagged_union(spark):
    df = spark.range(2)
    assert rows_of(cleaning.tagged_union({"a": df, "b": df}, "part")) == [(0, "a"), (0, "b"), (1, "a"), (1, "b")]


def test_zero_guard(spark):
    df = spark.createDataFrame([(1, 0), (1, 2)], "a int, b int")
    assert [r[0] for r in df.select(fx.safe_ratio("a", "b")).collect()] == [0.0, 0.5]


def test_feature_table_keeps_every_row(spark, sf_dir):
    from delaywright.operators.feature_table import ENGINEERED, flight_features
    from delaywright.plans.views import flights

    base = flights(spark, sf_dir)
    built = flight_features(base, as_of=dt.date(2024, 2, 1))
    assert built.count() == base.count()
    assert set(ENGINEERED) <= set(built.columns)
    # splitting every aircraft and airport changes nothing
    split = flight_features(base, as_of=dt.date(2024, 2, 1), rows_per_task=3)
    assert rows_of(split, "flight_id", *ENGINEERED) == rows_of(built, "flight_id", *ENGINEERED)


def test_raw_flights_are_typed_and_guarded(spark):
    from delaywright.sources import schemas

    raw = spark.createDataFrame(
        [("2015-01-02", "1345", "-3.0", "0.05s", "AA", "17.0"), ("bad", "", "x", "1.5", "DL", None)],
        "FL_DATE string, CRS_DEP_TIME string, DEP_DELAY string, HourlyPrecipitation string, OP_CARRIER string, ARR_DELAY string",
    )
    typed = schemas.type_raw_flights(raw)
    assert [t for _, t in typed.dtypes] == ["date", "int", "int", "double", "string", "int"]
    assert typed.collect() == [
        (dt.date(2015, 1, 2), 1345, -3, None, "AA", 17),
        (None, None, None, 1.5, "DL", None),
    ]
    # arrival delays are not known before departure
    assert schemas.known_before_departure(typed).columns == ["FL_DATE", "OP_CARRIER", "HourlyPrecipitation", "DEP_DELAY"]
    featured = spark.createDataFrame([("12", "3.0", "2015-01-02")], "parallel_flights string, DISTANCE string, FL_DATE string")
    assert schemas.type_feature_table(featured).first() == (12, 3.0, dt.date(2015, 1, 2))
