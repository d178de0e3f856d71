"""Model reports against plain figures, and every search: one metric set per trial, best is least."""

import json
import math
import statistics

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from delaywright.learning import models, search
from delaywright.operators import evaluation
from delaywright.plans import all_queries, training
from tests.conftest import SMALL


def test_report_equals_plain_figures(spark):
    rows = [("train", float(i % 50), float((i * 7) % 40), int(i % 50 >= 15)) for i in range(300)]
    rows += [("test", float(i % 60), float((i * 11) % 50), int(i % 60 >= 15)) for i in range(200)]
    scored = spark.createDataFrame(rows, "part string, label double, prediction double, late int")
    every = scored.select("part").unionByName(spark.createDataFrame([("test",)] * 7, "part string"))
    found = {r["part"]: r for r in evaluation.report_by_part(scored, every, "label", "late").collect()}
    sigma = statistics.stdev(label - p for part, label, p, _ in rows if part == "train")
    for part in ("train", "test"):
        own = [(label, p, late) for name, label, p, late in rows if name == part]
        hit = [(p + sigma >= 15, late) for _, p, late in own]
        tp = sum(1 for h, late in hit if h and late)
        fp = sum(1 for h, late in hit if h and not late)
        fn = sum(1 for h, late in hit if not h and late)
        r = found[part]
        assert math.isclose(r["sigma"], sigma) and (r["tp"], r["fp"], r["fn"]) == (tp, fp, fn)
        assert math.isclose(r["mae"], statistics.fmean(abs(label - p) for label, p, _ in own))
        assert math.isclose(r["precision"], tp / (tp + fp)) and math.isclose(r["recall"], tp / (tp + fn))
    assert (found["train"]["skipped"], found["test"]["skipped"], found["test"]["rows"]) == (0, 7, 207)


def test_linear_report_is_that_of_its_scores(spark):
    report = {r["part"]: r for r in all_queries()["report_linear"](spark, SMALL).collect()}
    train, _, parts = training._train_test(spark, SMALL)
    scored = models.linear_pipeline(training.SPEC, training.TARGET).fit(train).transform(parts)
    classes = evaluation.classify_intervals(scored, training.TARGET, sigma_rows=F.col("part") == "train")
    again = evaluation.precision_recall_fbeta(classes, "predicted_interval_delayed_binary", "dep_del15", by=["part"])
    for r in again.collect():
        mine = report[r["part"]]
        assert abs(mine["tp"] - r["tp"]) <= 1 and mine["scored"] == r["tp"] + r["fp"] + r["fn"] + r["tn"]
    assert set(report) == {"train", "validation", "test"}
    unknown = parts.filter("prior_flight_dep_delay_new IS NULL OR reading IS NULL OR station_distance IS NULL")
    assert sum(r["skipped"] for r in report.values()) == unknown.count() > 0


def test_boosted_report_covers_every_part(spark):
    report = all_queries()["report_boosted"](spark, SMALL).collect()
    assert {r["part"] for r in report} == {"train", "validation", "test"}
    assert all(0 <= r["precision"] <= 1 and 0 <= r["recall"] <= 1 and r["mae"] > 0 for r in report)


def test_weighted_figures_equal_the_evaluator(spark):
    rows = [(float(i % 3 == 0), float(i % 4 == 0), "all") for i in range(120)]
    df = spark.createDataFrame(rows, "prediction double, sign_delay double, part string")
    counts = training.summaries.confusion_counts(df, "prediction", "sign_delay", ["part"])
    found = training._weighted(counts).first()
    judge = MulticlassClassificationEvaluator(labelCol="sign_delay")
    for name, metric in (("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")):
        assert math.isclose(found[name], judge.copy({judge.metricName: metric}).evaluate(df), abs_tol=1e-6)


def runs_of(spark, name):
    runs = {}
    for r in all_queries()[name](spark, SMALL).collect():
        runs.setdefault(r["run_id"], {}).setdefault(r["kind"], {})[r["name"]] = r["value"]
    return runs


def test_random_search_records_each_trial(spark):
    runs = runs_of(spark, "tune_random")
    assert len(runs) == 4
    for run in runs.values():
        assert "error" not in run and set(run["param"]) == set(search.BOOSTED_SPACE)
        for part in ("train", "test"):
            assert {f"{part}_{m}" for m in ("mae", "precision", "recall", "fbeta")} <= set(run["metric"])
        assert run["metric"]["loss"] == run["metric"]["test_mae"]
        kept = GBTRegressionModel.load(run["path"]["model"])
        weights = {k: float(v) for k, v in run["metric"].items() if k.startswith("importance_")}
        assert len(weights) == sum(1 for v in kept.featureImportances.toArray() if v)
    rows = [(i, "metric", "loss", r["metric"]["loss"]) for i, r in runs.items()]
    best = search.best_run(search.run_rows(spark, rows), "loss").first()
    assert best["metric_value"] == min(float(r["metric"]["loss"]) for r in runs.values())


def test_cross_validation_keeps_and_scores_the_best_pipeline(spark):
    runs = runs_of(spark, "cv_random")
    assert len([r for r in runs if r.startswith("point-")]) == 9
    names = {f"{p}_{m}" for p in ("train", "test") for m in ("weightedRecall", "weightedTruePositiveRate", "weightedFMeasure")}
    assert set(runs["best"]["metric"]) == names
    assert all(0 <= float(v) <= 1 for v in runs["best"]["metric"].values())
    assert len(models.load_model(runs["best"]["model"]["path"]).stages) > 1


def test_perceptron_search_records_each_trial(spark):
    runs = runs_of(spark, "tune_mlp")
    assert len(runs) == 8
    for run in runs.values():
        assert {f"{p}_{m}" for p in ("train", "test") for m in ("precision", "recall", "f1")} <= set(run["metric"])
        assert all(0 <= float(v) <= 1 for k, v in run["metric"].items() if k != "loss")


def test_logged_runs_keep_their_models(spark):
    runs = runs_of(spark, "run_log_rows")
    assert all(len(models.load_model(run["model"]["path"]).stages) > 1 for run in runs.values())


@pytest.mark.parametrize("name", ["tune_grid_timefold"])
def test_other_searches_have_rows(spark, name):
    rows = [r.asDict() for r in all_queries()[name](spark, SMALL).collect()]
    assert rows and json.dumps(rows, default=str).count("error") == 0
