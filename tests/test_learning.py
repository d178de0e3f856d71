"""Pipelines, models and search on a small separable problem."""

import pytest
from pyspark.sql import functions as F

from delaywright.learning import features as ft
from delaywright.learning import models, search
from delaywright.operators import splitting

SPEC = ft.FeatureSpec(categorical=("c",), numeric=("x", "z"))


@pytest.fixture(scope="module")
def rows(spark):
    ids = spark.range(600).withColumnRenamed("id", "row_id")
    noise = F.pmod(F.xxhash64("row_id"), F.lit(100)) / 100.0
    df = ids.select(
        "row_id",
        F.date_add(F.lit("2015-01-01").cast("date"), (F.col("row_id") / 20).cast("int")).alias("d"),
        F.when(F.col("row_id") % 5 == 0, "a").when(F.col("row_id") % 5 == 1, "b").otherwise("c").alias("c"),
        (F.col("row_id") % 17).cast("double").alias("x"),
        F.when(F.col("row_id") % 41 == 0, None).otherwise(noise).alias("z"),
    )
    label = 3.0 * F.col("x") + F.when(F.col("c") == "a", 20.0).otherwise(0.0) + noise
    return df.withColumn("y", label).withColumn("late", (F.col("y") > 30).cast("double")).cache()


def baseline_mae(rows):
    mean = rows.agg(F.avg("y")).first()[0]
    return rows.agg(F.avg(F.abs(F.col("y") - mean))).first()[0]


def test_rows_with_unknown_features_are_skipped(rows):
    model = models.linear_pipeline(SPEC, "y").fit(rows)
    assert model.transform(rows).count() == rows.filter("z is not null").count()


def test_linear_beats_the_mean_and_names_widened_slots(rows):
    model = models.linear_pipeline(SPEC, "y").fit(rows)
    scored = model.transform(rows)
    assert search.mean_absolute_error(scored, "y") < baseline_mae(rows) / 3
    listed = {r["feature"]: r["value"] for r in models.coefficients(model, scored).collect()}
    assert set(listed) == {"c_encoded_c", "c_encoded_a", "x", "z"}
    assert listed["x"] > listed["c_encoded_a"] > 0


def test_l1_drops_the_noise(rows):
    model = models.linear_pipeline(SPEC, "y", {"regParam": 1.0, "elasticNetParam": 1.0}).fit(rows)
    kept = {r["feature"] for r in models.selected_features(model, model.transform(rows)).collect()}
    assert "x" in kept and "z" not in kept


def test_boosted_trees_and_importances(rows):
    spec = ft.FeatureSpec(SPEC.categorical, SPEC.numeric, one_hot=False)
    parts = splitting.split_train_val_test(rows, "d", "row_id")
    flagged = splitting.training_with_validation_flag(parts)
    params = {**models.BOOSTED_TUNED, "maxIter": 5, "minInstancesPerNode": 5}
    model = models.boosted_pipeline(spec, "y", params).fit(flagged)
    scored = model.transform(parts)
    assert search.mean_absolute_error(scored, "y") < baseline_mae(rows)
    top = models.importances(model, scored).orderBy(F.desc("value")).first()
    assert top["feature"] == "x"


def test_perceptron_width_follows_the_vector(rows):
    model = models.fit_perceptron(SPEC, rows, "late", hidden=(5,), params={"maxIter": 5, "seed": 1})
    assert model.stages[-1].getLayers()[0] == 4
    assert model.transform(rows).select("prediction").distinct().count() >= 1


def test_saved_model_scores_the_same(rows):
    model = models.linear_pipeline(SPEC, "y").fit(rows)
    again = models.reload(model, rows)
    pairs = model.transform(rows).select("row_id", "prediction").join(
        again.transform(rows).select("row_id", F.col("prediction").alias("p2")), "row_id"
    )
    assert pairs.filter("prediction <> p2").count() == 0


def test_standard_scaler_variant(rows):
    spec = ft.FeatureSpec((), ("x",), scaler="standard")
    assert type(spec.stages()[-1]).__name__ == "StandardScaler"


def test_draws_are_seeded_and_inside_the_space():
    first, second = (search.draw_trials(search.BOOSTED_SPACE, 15, seed=4) for _ in range(2))
    assert first == second
    assert all(10 <= t.params["maxIter"] <= 100 and t.params["maxDepth"] in (5, 7, 10) for t in first)


def test_failing_trial_is_recorded(spark):
    def evaluate(trial):
        if trial.params["a"] == 2:
            raise ValueError("no")
        return {"mae": trial.params["a"]}

    runs = search.run_rows(spark, search.run_trials(spark, search.grid_trials({"a": [3, 2, 1]}), evaluate))
    assert runs.filter("kind = 'error'").count() == 1
    best = search.best_run(runs, "mae").collect()
    assert [(r["run_id"], r["value"]) for r in best] == [("grid-3", "1")]


def test_grid_over_time_folds(rows):
    from pyspark.ml.regression import LinearRegression

    folds = splitting.fold_predicates(rows, "d", "row_id", splitting.sliding_folds(rows.count())[:2])
    cells = search.grid_over_folds(
        rows, folds, SPEC, lambda p: LinearRegression(featuresCol="features", labelCol="y", **p),
        {"regParam": [0.01, 50.0]}, "y",
    )
    summary = {r["params"]: r for r in search.grid_summary(cells).collect()}
    assert summary["regParam=0.01"]["mae_mean"] < summary["regParam=50.0"]["mae_mean"]
    assert all(r["folds"] == 2 for r in summary.values())


def test_training_frames_are_not_over_partitioned(rows):
    sized = ft.cache_for_training(rows.repartition(7))
    assert sized.rdd.getNumPartitions() == 1 and sized.count() == rows.count()
    kept = ft.cache_for_training(rows.repartition(3), rows_per_partition=100)
    assert kept.rdd.getNumPartitions() == 3


def test_one_huge_partition_is_dealt_out(spark):
    # 4,999 of 5,000 rows in one of 60 partitions, as one key of a join leaves them
    owner = F.when(F.col("id") < 4_999, 0).otherwise(F.col("id"))
    held = ft.cache_for_training(spark.range(5_000).repartition(60, owner), rows_per_partition=100)
    sizes = [r["count"] for r in held.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 5_000 and max(sizes) <= 400
