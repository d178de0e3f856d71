"""Metrics against row-by-row Python, and the properties that tie them together."""

import random
import statistics

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import functions as F

from delaywright.operators import evaluation as ev
from delaywright.operators import ranking, summaries


@pytest.fixture(scope="module")
def data():
    source = random.Random(3)
    rows = []
    for i in range(400):
        label = max(0.0, source.gauss(10, 25))
        rows.append((i, label, label * 0.5 + source.gauss(6, 8), int(label >= 15), "train" if i < 300 else "test"))
    return rows


@pytest.fixture(scope="module")
def scored(spark, data):
    return spark.createDataFrame(data, "id int, label double, prediction double, late int, part string").cache()


def prf(pairs):
    tp = sum(p and a for p, a in pairs)
    fp = sum(p and not a for p, a in pairs)
    fn = sum((not p) and a for p, a in pairs)
    precision = tp / (tp + fp) if tp + fp else 0.0
    recall = tp / (tp + fn) if tp + fn else 0.0
    f2 = 5 * precision * recall / (4 * precision + recall) if precision + recall else 0.0
    return precision, recall, f2


def test_mae_and_sigma(scored, data):
    mae = ev.mean_absolute_error(scored, "label").first()["mae"]
    assert mae == pytest.approx(RegressionEvaluator(labelCol="label", metricName="mae").evaluate(scored))
    sigma = ev.residual_stddev(scored, "label").first()["sigma"]
    assert sigma == pytest.approx(statistics.stdev(r[1] - r[2] for r in data))


def test_sigma_comes_from_the_training_rows(scored, data):
    sigma = statistics.stdev(r[1] - r[2] for r in data if r[4] == "train")
    row = ev.classify_intervals(scored, "label", sigma_rows=F.col("part") == "train").first()
    assert row["upper_bound"] - row["prediction"] == pytest.approx(sigma)


def test_interval_classes(scored):
    rows = ev.classify_intervals(scored, "label").collect()
    for r in rows:
        expected = 1.0 if r["lower_bound"] >= 15 else 0.0 if r["upper_bound"] < 15 else 2.0
        assert r["predicted_interval_delayed"] == expected
        assert r["prediction_confidence"] == ("uncertain" if expected == 2.0 else "high")
        assert r["predicted_interval_delayed_binary"] == float(r["upper_bound"] >= 15)
        assert r["predicted_delayed"] == float(r["prediction"] >= 15)


@pytest.mark.parametrize("multiplier", [0.5, 1.0])
def test_sweep_equals_direct_metrics(scored, data, multiplier):
    grid = ev.multiplier_grid(-2, 2, 0.1)
    row = ev.sweep_multipliers(scored, grid, "label").filter(F.col("multiplier") == multiplier).first()
    direct = ev.classify_intervals(scored, "label", multiplier=multiplier)
    same = ev.precision_recall_fbeta(direct, "predicted_interval_delayed_binary", "late").first()
    assert (row["tp"], row["fp"], row["fn"]) == (same["tp"], same["fp"], same["fn"])
    sigma = statistics.stdev(r[1] - r[2] for r in data)
    expected = prf([(r[2] + sigma * multiplier >= 15, r[1] >= 15) for r in data])
    assert (row["precision"], row["recall"], row["fbeta"]) == pytest.approx(expected)


def test_best_multiplier(scored):
    sweep = ev.sweep_multipliers(scored, ev.multiplier_grid(0, 0.6, 0.02), "label")
    assert sweep.count() == 31
    assert ev.best_multiplier(sweep).first()["fbeta"] == sweep.agg(F.max("fbeta")).first()[0]


def test_metrics_without_positives_are_zero(spark):
    none = spark.createDataFrame([(0, 0), (0, 0)], "p int, a int")
    row = ev.precision_recall_fbeta(none, "p", "a").first()
    assert (row["precision"], row["recall"], row["fbeta"]) == (0.0, 0.0, 0.0)


def test_weighted_metrics_match_the_library(scored):
    points = scored.withColumn("p", (F.col("prediction") >= 15).cast("double")).withColumn("a", F.col("late").cast("double"))
    ours = ev.weighted_metrics(points, "p", "a").first()
    for column, metric in (
        ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"),
        ("weighted_fpr", "weightedFalsePositiveRate"),
        ("weighted_f1", "f1"),
    ):
        judge = MulticlassClassificationEvaluator(labelCol="a", predictionCol="p", metricName=metric)
        assert ours[column] == pytest.approx(judge.evaluate(points))
    rates = {r["label"]: r for r in ev.by_label_rates(points, "p", "a").collect()}
    judge = MulticlassClassificationEvaluator(
        labelCol="a", predictionCol="p", metricName="truePositiveRateByLabel", metricLabel=1.0
    )
    assert rates[1]["tpr"] == pytest.approx(judge.evaluate(points))


@pytest.mark.parametrize("rows_per_range", [25, 1_000_000])
def test_roc_area(scored, rows_per_range):
    area = ranking.roc_area(scored, "prediction", "late", rows_per_range).first()["auc"]
    judge = BinaryClassificationEvaluator(labelCol="late", rawPredictionCol="prediction", numBins=0)
    assert area == pytest.approx(judge.evaluate(scored))


def test_confusion_matrix_has_all_cells(spark):
    df = spark.createDataFrame([(1.0, 1), (1.0, 1), (1.0, 0)], "p double, a int")
    third = df.limit(1).select(F.lit(2).alias("p"), "a").unionByName(df.select("p", "a"))
    assert "predicted_2" in summaries.confusion_matrix(third, "p", "a").columns
    with pytest.raises(ValueError, match="2"):
        summaries.confusion_matrix(third, "p", "a", (0, 1))
    matrix = {r["actual"]: (r["predicted_0"], r["predicted_1"]) for r in summaries.confusion_matrix(df, "p", "a").collect()}
    assert matrix == {0: (0, 1), 1: (0, 2)}


def test_confidence_report(scored, data):
    report = ev.confidence_report(ev.classify_intervals(scored, "label", multiplier=0.5), "late").first()
    sigma = statistics.stdev(r[1] - r[2] for r in data) * 0.5
    sure = [(r[2] - sigma >= 15, r[3]) for r in data if r[2] - sigma >= 15 or r[2] + sigma < 15]
    assert report["uncertain_pct"] == pytest.approx(100 * (1 - len(sure) / len(data)))
    assert report["accuracy"] == pytest.approx(sum(p == bool(a) for p, a in sure) / len(sure))
    assert (report["precision"], report["recall"], report["fbeta"]) == pytest.approx(prf(sure))


def test_train_and_test_metrics_differ(scored):
    scored_parts = ev.classify_intervals(scored, "label", sigma_rows=F.col("part") == "train")
    found = {r["part"]: r for r in ev.metrics_by_part(scored_parts, "label", "late").collect()}
    assert found["train"]["mae"] != found["test"]["mae"]


def spearman(xs, ys):
    def ranks(values):
        order = sorted(values)
        return [order.index(v) + (order.count(v) + 1) / 2 for v in values]

    return statistics.correlation(ranks(xs), ranks(ys))


@pytest.mark.parametrize("rows_per_range,rows_per_task,limit", [(1_000_000, 5_000_000, 400_000), (10, 20, 0)])
def test_spearman(spark, monkeypatch, rows_per_range, rows_per_task, limit):
    monkeypatch.setattr(ranking, "BROADCAST_VALUES", limit)
    source = random.Random(5)
    rows = [
        (0.0 if source.random() < 0.34 else source.gauss(0, 9), source.randrange(30), source.choice([None, 1, 2, 3]))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "a double, b int, c int")
    found = ranking.spearman_pairs(df, ["a", "b", "c"], rows_per_task, rows_per_range)
    rho = {(r["col_a"], r["col_b"]): r["rho"] for r in found.collect()}
    assert rho["a", "b"] == pytest.approx(spearman([r[0] for r in rows], [r[1] for r in rows]))
    known = [r for r in rows if r[2] is not None]
    assert rho["a", "c"] == pytest.approx(spearman([r[0] for r in known], [r[2] for r in known]))
    assert rho["b", "c"] == pytest.approx(spearman([r[1] for r in known], [r[2] for r in known]))


def test_spearman_of_monotone_data_is_pearson_of_ranks(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), (F.col("id") * 3.0 + 1).alias("b"))
    assert ranking.spearman_pairs(df, ["a", "b"]).first()["rho"] == pytest.approx(1.0)
    assert ranking.pearson_pairs(df, ["a", "b"]).first()["r"] == pytest.approx(1.0)


@pytest.mark.parametrize("rows_per_range", [7, 1_000_000])
def test_prefix_sums(spark, rows_per_range):
    table = spark.createDataFrame([(i * 3, i % 5) for i in range(100)], "v int, n int")
    found = {r["v"]: r["before_n"] for r in ranking.prefix_sums(table, "v", ["n"], rows_per_range).collect()}
    running = 0
    for i in range(100):
        assert found[i * 3] == running
        running += i % 5
