"""Hot keys: the split paths give exactly what a plain window or join gives."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from delaywright.operators import joins, skew, windows
from delaywright.operators.skew import LastBefore, LastKnown, NextKnown, OrderedScan, Position, Previous, attach, join_lookup
from tests.conftest import plan_text, rows_of


@pytest.fixture(scope="module")
def skewed(spark):
    """6000 rows: key 0 holds a third, a block of them at one and the same time; some nulls."""
    ids = spark.range(6000).withColumnRenamed("id", "row_id")
    return ids.select(
        "row_id",
        F.when(F.col("row_id") % 3 == 0, 0)
        .when(F.col("row_id") % 97 == 5, None)
        .otherwise(F.col("row_id") % 50 + 1)
        .cast("int")
        .alias("k"),
        F.when(F.col("row_id") % 6 == 0, 100).otherwise(F.pmod(F.xxhash64("row_id"), F.lit(500))).alias("t"),
        F.when(F.pmod(F.xxhash64("row_id", F.lit(3)), F.lit(4)) > 0, (F.col("row_id") % 71).cast("double")).alias("v"),
    ).cache()


def test_ordered_scan_matches_plain_window(spark, skewed):
    order = ["t", "row_id"]
    window = Window.partitionBy("k").orderBy(*order)
    expected = skewed.select(
        "row_id",
        F.row_number().over(window).cast("bigint").alias("pos"),
        F.lag("v").over(window).alias("prev"),
        F.last("v", ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0)).alias("known"),
    )
    scan = OrderedScan(["k"], order, rows_per_task=150)
    found = scan.run(skewed, pos=Position(), prev=Previous("v"), known=LastKnown("v"))
    assert rows_of(found, "row_id", "pos", "prev", "known") == rows_of(expected)


def test_ordered_scan_splits_only_hot_keys(skewed):
    hot, rows = OrderedScan(["k"], ["t", "row_id"], rows_per_task=150)._hot_keys(skewed)
    assert [tuple(r) for r in hot.collect()] == [(0,)]
    assert rows == skewed.filter("k = 0").count()


def test_hot_slices_are_bounded(spark, skewed):
    """No window of the split path holds much more than rows_per_task rows."""
    staged = (
        skewed.filter("k = 0").repartitionByRange(14, "k", "t", "row_id").groupBy(F.spark_partition_id()).count()
    )
    assert max(r["count"] for r in staged.collect()) < 600


def test_attach_matches_join(skewed):
    summary = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))
    found = attach(skewed, summary, ["k"], "n", ["row_id"], rows_per_task=100)
    assert found.count() == skewed.count()
    window = Window.partitionBy("k")
    expected = skewed.select("row_id", F.count(F.lit(1)).over(window), F.sum("v").over(window))
    assert rows_of(found, "row_id", "n", "total") == rows_of(expected)


def test_attach_spreads_the_hot_key(skewed):
    summary = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    plan = attach(skewed, summary, ["k"], "n", ["row_id"], 100)._jdf.queryExecution().analyzed().toString()
    assert "_salt" in plan and "xxhash64" in plan


@pytest.mark.parametrize("rows_per_task", [40, 5_000_000])
def test_window_features_do_not_depend_on_the_split(skewed, rows_per_task):
    base = skewed.select("row_id", "k", (F.col("t") % 300).alias("m"), "v").withColumn("d", F.col("row_id") % 2)
    ordered = windows.departure_order(base, ["d", "k"], "m", "row_id", rows_per_task)
    window = Window.partitionBy("d", "k").orderBy("m", "row_id")
    lagged = F.lag("m").over(window)
    expected = base.withColumn("same", lagged == F.col("m")).select(
        "row_id",
        F.count(F.lit(1)).over(Window.partitionBy("d", "k", "m")),
        "same",
        F.sum(F.when(F.col("same"), 0).otherwise(1)).over(Window.partitionBy("d", "k").orderBy("m")),
    )
    assert rows_of(ordered, "row_id", "parallel_flights", "same_dep_time", "flight_order") == rows_of(expected)

    around = windows.flights_within(base, ["k"], "m", "row_id", 15, rows_per_task=rows_per_task)
    span = Window.partitionBy("k").orderBy("m").rangeBetween(-15, 15)
    assert rows_of(around, "row_id", "parallel_flights") == rows_of(
        base.select("row_id", F.count(F.lit(1)).over(span))
    )

    looked_up = windows.last_known_delay(base, ["d", "k"], "m", "v", "row_id", 60, rows_per_task=rows_per_task)
    earlier = Window.partitionBy("d", "k").orderBy("m").rangeBetween(Window.unboundedPreceding, -60)
    best = F.max(F.when(F.col("v").isNotNull(), F.struct("m", "row_id", "v"))).over(earlier)
    assert rows_of(looked_up, "row_id", "dep_delay_previous") == rows_of(
        base.select("row_id", F.coalesce(best["v"], F.lit(0.0)))
    )


def test_flights_within_crosses_midnight(spark):
    rows = spark.createDataFrame([(1, 1, 1435), (2, 1, 1445), (3, 1, 1460), (4, 1, 1466)], "id int, g int, m bigint")
    found = dict(windows.flights_within(rows, ["g"], "m", "id", 15).select("id", "parallel_flights").collect())
    assert found == {1: 2, 2: 3, 3: 3, 4: 2}


def brute_asof(left, right):
    out = {}
    for lid, k, t in left:
        hits = [(rt, rid, v) for rid, rk, rt, v in right if k is not None and rk == k and t is not None and rt <= t]
        out[lid] = max(hits)[1:] if hits else (None, None)
    return out


@pytest.mark.parametrize("rows_per_task", [25, 5_000_000])
def test_asof_join(spark, rows_per_task):
    left = [(i, 0 if i % 3 else i % 5, (i * 37) % 200 if i % 11 else None) for i in range(300)]
    right = [(i, 0 if i % 3 else i % 5, (i * 53) % 200, float(i)) for i in range(300)]
    left += [(300 + i, None, 150) for i in range(40)]
    right += [(300 + i, None, i, 0.0) for i in range(40)]
    left_df = spark.createDataFrame(left, "lid int, k int, t int")
    right_df = spark.createDataFrame(right, "rid int, k int, rt int, v double")
    joined = joins.asof_join(
        left_df, right_df, ["k"], "t", "rt", "lid", "rid", ["rid", "v"], rows_per_task=rows_per_task
    )
    assert {r["lid"]: (r["rid"], r["v"]) for r in joined.collect()} == brute_asof(left, right)


@pytest.mark.parametrize("rows_per_task", [20, 5_000_000])
def test_nearest_by_value(spark, rows_per_task):
    left = [(i, i % 2, float((i * 13) % 90)) for i in range(60)]
    right = [(i, i % 3, float((i * 7) % 80)) for i in range(90)]
    found = joins.nearest_by_value(
        spark.createDataFrame(left, "lid int, k int, a double"),
        spark.createDataFrame(right, "rid int, k int, b double"),
        ["k"], "a", "b", "lid", "rid", rows_per_task,
    )
    expected = []
    for lid, k, a in left:
        gap, rid = min((abs(b - a), rid) for rid, rk, b in right if rk == k)
        expected.append((lid, rid, gap))
    assert rows_of(found, "lid", "rid", "gap") == sorted(expected, key=repr)


def test_nearest_per_key_takes_lowest_candidate(spark):
    pairs = spark.createDataFrame([("A", 9, 2.0), ("A", 3, 2.0), ("B", 1, 5.0)], "a string, s int, d double")
    assert rows_of(joins.nearest_per_key(pairs, "a", "s", "d")) == [("A", 3, 2.0), ("B", 1, 5.0)]


def test_prior_delay_floors_at_zero(spark):
    rows = spark.createDataFrame([(1, 1, -4.0), (2, 2, None), (3, 3, 7.0), (4, 4, 1.0)], "id int, t int, d double")
    found = windows.prior_delay(rows.withColumn("tail", F.lit(1)), ["tail"], ["t", "id"], "d")
    assert rows_of(found, "id", "prior_flight_dep_delay_new") == [(1, None), (2, 0.0), (3, None), (4, 7.0)]


@pytest.mark.parametrize("rows_per_task", [20, 5_000_000])
def test_known_prior_delay_leaves_two_hours(spark, rows_per_task):
    rows = [(i, "hot" if i % 3 else f"t{i % 4}", i * 37 % 900, float(i % 7 - 2)) for i in range(200)]
    rows += [(900, None, 500, 1.0), (901, None, 800, 1.0), (902, "hot", None, 5.0)]
    df = spark.createDataFrame(rows, "id int, tail string, minute int, d double").withColumn(
        "ts", F.timestamp_seconds(F.col("minute") * 60)
    )
    found = windows.known_prior_delay(df, "tail", "ts", "id", "d", rows_per_task=rows_per_task)
    got = dict(rows_of(found, "id", "prior_flight_dep_delay_new"))
    for i, tail, minute, _ in rows:
        known = [(m, j, d) for j, t, m, d in rows if t is not None and t == tail and m is not None and minute is not None and m <= minute - 120]
        assert got[i] == (max(0.0, max(known)[2]) if known else None)


@pytest.mark.parametrize("max_rows", [0, 200_000])
def test_lookups_join_alike_broadcast_and_spread(spark, max_rows):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 7}" if i % 5 else None) for i in range(300)], "id int, k string")
    lookup = spark.createDataFrame([("hot", 1.0), ("k0", 2.0), ("k3", 3.0), (None, 9.0)], "k string, v double")
    found = join_lookup(rows, lookup, ["k"], ["id"], max_rows, rows_per_task=25)
    known = {"hot": 1.0, "k0": 2.0, "k3": 3.0}
    assert rows_of(found, "id", "k", "v") == sorted(((r["id"], r["k"], known.get(r["k"])) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("rows_per_task", [7, 150, 5_000_000])
def test_values_ahead_and_some_time_back(spark, skewed, rows_per_task):
    """Next known values, and values at least 60 back: frames of one plain window, in one shuffle."""
    window = Window.partitionBy("k").orderBy("t", "row_id")
    ahead = window.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    back = Window.partitionBy("k").orderBy("t").rangeBetween(Window.unboundedPreceding, -60)
    expected = skewed.select(
        "row_id",
        F.first("v", ignorenulls=True).over(ahead).alias("ahead"),
        F.max(F.struct("t", "row_id", "v")).over(back)["v"].alias("back"),
    )
    scan = OrderedScan(["k"], ["t", "row_id"], rows_per_task)
    found = scan.run(skewed, ahead=NextKnown("v"))
    found = scan.run(found, skewed, back=LastBefore("v", "60"))
    assert found.columns == [*skewed.columns, "ahead", "back"]
    assert rows_of(found, "row_id", "ahead", "back") == rows_of(expected)


def test_values_some_time_back_are_a_scan_of_their_own(skewed):
    scan = OrderedScan(["k"], ["t", "row_id"], 150)
    with pytest.raises(ValueError):
        scan.run(skewed, a=LastBefore("v", "1"), b=Position())


def test_hot_keys_go_through_one_shuffle(spark, sf_dir, monkeypatch):
    """With a hot key, what is written holds one scan of the source and one shuffle of its rows."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    staged = []
    spool = skew.spool
    monkeypatch.setattr(skew, "spool", lambda df, tag: staged.append(plan_text(df)) or spool(df, tag))
    scan = OrderedScan(["event_type"], ["ts", "event_id"], rows_per_task=40)
    assert scan.run(events, n=Position(), v=Previous("value")).count() == events.count()
    assert len(staged) == 1 and staged[0].count("FileScan") == 1 and staged[0].count("Exchange hashpartitioning") == 1


def test_bounds_are_found_in_chunks(spark):
    rows = spark.range(500).select("id", F.expr("transform(sequence(1, 150), x -> x * 3)").alias("_bounds"))
    found = rows.select("id", skew._bounds_below(lambda b: b <= F.col("id")).alias("n")).collect()
    assert {r["id"]: r["n"] for r in found} == {i: min(150, i // 3) for i in range(500)}
