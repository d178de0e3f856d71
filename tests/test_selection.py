"""Order statistics, quantiles, splits and folds against sorting everything."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from delaywright.operators import cleaning, profiling, splitting
from delaywright.operators.selection import exact_quantiles, order_statistics
from tests.conftest import rows_of


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


@pytest.mark.parametrize("seed", range(4))
def test_order_statistics_with_tiny_brackets(spark, seed):
    source = random.Random(seed)
    # a third of all values are one and the same
    values = [7.0 if source.random() < 0.33 else round(source.gauss(10, 50), 1) for _ in range(3000)]
    values += [None] * 20
    present = sorted(v for v in values if v is not None)
    ranks = [1, 2, 17, 500, 1000, 1500, 2000, len(present) - 1, len(present)]
    found = order_statistics(frame(spark, values), [("x", r) for r in ranks], finish_rows=10)
    assert found == [present[r - 1] for r in ranks]


def test_order_statistics_of_a_constant(spark):
    assert order_statistics(frame(spark, [4.0] * 500), [("x", 1), ("x", 250), ("x", 500)], finish_rows=5) == [4.0] * 3


def test_order_statistics_rejects_missing_rank(spark):
    with pytest.raises(ValueError):
        order_statistics(frame(spark, [1.0]), [("x", 2)])


def test_exact_quantiles_match_numpy(spark):
    source = random.Random(1)
    values = [source.expovariate(0.02) for _ in range(2345)]
    probabilities = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    found = exact_quantiles(frame(spark, values), ["x"], probabilities, finish_rows=20)["x"]
    assert found == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12)


def test_quantiles_of_an_empty_column(spark):
    assert exact_quantiles(frame(spark, [None, None]), ["x"], [0.5])["x"] == [None]


@pytest.fixture(scope="module")
def dated(spark):
    """2000 rows; one day holds a third of them."""
    ids = spark.range(2000)
    day = F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.xxhash64("id"), F.lit(30))).cast("int")
    return ids.select("id", F.date_add(F.lit("2015-01-01").cast("date"), day).alias("d")).cache()


@pytest.mark.parametrize("positions", [[1600], [1120, 1600], [0, 1, 700, 1999, 2000]])
def test_cuts_equal_row_number(dated, positions):
    number = F.row_number().over(Window.orderBy("d", "id"))
    numbered = {r["id"]: r["n"] for r in dated.withColumn("n", number).collect()}
    for position, cut in zip(positions, splitting.chronological_cuts(dated, "d", "id", positions)):
        inside = {r["id"] for r in dated.filter(cut.upto("d", "id")).collect()}
        assert inside == {i for i, n in numbered.items() if n <= position}


def test_split_partitions_rows_in_time(dated):
    parts = splitting.split_train_val_test(dated, "d", "id")
    sizes = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
    assert sizes == {"train": 1120, "validation": 480, "test": 400}
    report = {r["part"]: r for r in splitting.split_report(parts, "d").collect()}
    assert report["train"]["last_day"] <= report["validation"]["first_day"]
    assert report["validation"]["last_day"] <= report["test"]["first_day"]
    assert sum(r["pct"] for r in report.values()) == pytest.approx(100)


def test_split_is_one_projection(dated):
    plan = splitting.split_train_test(dated, "d", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_sliding_and_expanding_folds():
    folds = splitting.sliding_folds(100)
    assert len(folds) == 5
    assert (folds[0].train_start, folds[0].train_end, folds[0].test_start, folds[0].test_end) == (1, 33, 34, 43)
    assert (folds[4].train_start, folds[4].test_end) == (41, 83)
    assert all(f.train_start == 1 for f in splitting.expanding_folds(100))
    assert splitting.sliding_folds(5) == []


def test_fold_predicates_pick_the_numbered_rows(dated):
    folds = splitting.sliding_folds(2000)
    number = F.row_number().over(Window.orderBy("d", "id"))
    numbered = dated.withColumn("n", number).cache()
    for fold in splitting.fold_predicates(dated, "d", "id", folds)[:2]:
        bounds = fold.fold
        got = numbered.filter(fold.test).agg(F.min("n"), F.max("n"), F.count("n")).first()
        assert tuple(got) == (bounds.test_start, bounds.test_end, bounds.test_end - bounds.test_start + 1)


def test_cuts_need_known_dates(spark):
    rows = spark.createDataFrame([(1, None)], "id bigint, d date")
    with pytest.raises(ValueError):
        splitting.chronological_cuts(rows, "d", "id", [1])


def test_clip_keeps_all_rows_and_nulls(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 100.0, None])
    clipped = [r["x"] for r in cleaning.clip_at_quantile(df, "x", 0.5).collect()]
    assert sorted(v for v in clipped if v is not None) == [1.0, 2.0, 2.5, 2.5] and None in clipped


def test_numeric_columns_are_found(spark):
    df = spark.createDataFrame([(1, 2.0, "a")], "i int, d double, s string")
    assert cleaning.numeric_columns(df) == ["i", "d"]


def test_outliers_and_quartiles(spark):
    df = frame(spark, [float(v) for v in range(1, 101)] + [1000.0, -1000.0])
    assert profiling.outlier_pct(df, ["x"]).first()["outlier_pct"] == pytest.approx(200 / 102)
    shares = profiling.quartile_shares(df, ["x"]).first()
    assert shares["q1"] + shares["q2"] + shares["q3"] < 1


def test_histogram_last_bin_is_closed(spark):
    bins = {r["bin"]: r["n"] for r in profiling.histogram(frame(spark, [0.0, 1.0, 9.0, 10.0, None]), "x", 10).collect()}
    assert bins == {0: 1, 1: 1, 9: 2}


def test_histogram_of_one_value(spark):
    bins = profiling.histogram(frame(spark, [3.0, 3.0]), "x", 5).collect()
    assert [(r["bin"], r["n"]) for r in bins] == [(0, 2)]


def test_prune_and_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "a int, b string")
    profile = {r["column"]: r["missing_pct"] for r in profiling.null_profile(df).collect()}
    assert profile["a"] == 0 and profile["b"] == pytest.approx(200 / 3)
    assert profiling.prune_sparse(df, 40).columns == ["a"]


def test_fixed_size_sample_is_repeatable(spark):
    df = spark.range(1000)
    first, second = (
        sorted(r["id"] for r in profiling.fixed_size_sample(d, 50, 3, ["id"]).collect())
        for d in (df, df.repartition(7))
    )
    assert first == second and len(set(first)) == 50


def test_cuts_need_a_date_column(spark):
    rows = spark.createDataFrame([(1, "2015-01-01")], "id bigint, d string")
    with pytest.raises(TypeError):
        splitting.chronological_cuts(rows, "d", "id", [1])


def test_nan_is_no_number(spark):
    rows = [(float(i),) for i in range(1, 101)] + [(float("nan"),)] * 30 + [(None,)] * 5
    df = spark.createDataFrame(rows, "x double")
    assert exact_quantiles(df, ["x"], [0.0, 0.5, 1.0])["x"] == [1.0, 50.5, 100.0]
    assert order_statistics(df, [("x", 100), ("x", 1)], finish_rows=10) == [100.0, 1.0]


def test_keyed_sample_draws_the_same_ids(spark):
    df = spark.range(5000)
    drawn = rows_of(profiling.keyed_sample(df, "id", 0.2))
    assert drawn == rows_of(profiling.keyed_sample(df.repartition(7), "id", 0.2)) and 850 < len(drawn) < 1150
    assert profiling.keyed_sample(df, "id", 0.0).count() == 0 and profiling.keyed_sample(df, "id", 1.0).count() >= 4999
