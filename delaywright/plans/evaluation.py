"""Metrics of the stand-in predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaywright.functions.expressions import recode
from delaywright.operators import evaluation as ev
from delaywright.operators import ranking, summaries
from delaywright.plans.registry import query
from delaywright.plans.views import SCORES, rounded, scores

TRAIN_SIGMA = "(SELECT stddev_samp(dep_delay_new - prediction) FROM v_pred WHERE part = 'train')"
ALL_SIGMA = "(SELECT stddev_samp(dep_delay_new - prediction) FROM v_pred)"


def _intervals_sql(sigma: str, multiplier: float = 1.0) -> str:
    return (
        SCORES
        + f""",
v_sig AS (SELECT *, {sigma} * {multiplier} AS spread FROM v_pred),
v_int AS (
  SELECT *, prediction - spread AS lower_bound, prediction + spread AS upper_bound,
    CAST(CASE WHEN prediction >= 15 THEN 1 ELSE 0 END AS DOUBLE) AS predicted_delayed,
    CAST(CASE WHEN prediction - spread >= 15 THEN 1 WHEN prediction + spread < 15 THEN 0 ELSE 2 END AS DOUBLE)
      AS predicted_interval_delayed,
    CAST(CASE WHEN prediction + spread >= 15 THEN 1 ELSE 0 END AS DOUBLE) AS predicted_interval_delayed_binary
  FROM v_sig)"""
    )


def _prf_sql(source: str, predicted: str, actual: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""v_c AS (SELECT {keys}count(*) FILTER ({predicted} = 1 AND {actual} = 1) AS tp,
      count(*) FILTER ({predicted} = 1 AND {actual} = 0) AS fp,
      count(*) FILTER ({predicted} = 0 AND {actual} = 1) AS fn FROM {source} {group}),
    v_pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p,
      CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM v_c),
    v_prf AS (SELECT *, CASE WHEN 4 * p + r > 0 THEN 5 * p * r / (4 * p + r) ELSE 0 END AS f FROM v_pr)"""


PRF_OUT = "tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f2"


def _prf_columns(df, *keys):
    return df.select(
        *keys,
        "tp",
        "fp",
        "fn",
        rounded("precision").alias("precision"),
        rounded("recall").alias("recall"),
        rounded("fbeta").alias("f2"),
    )


def _train():
    return F.col("part") == "train"


def _intervals(spark, sf_dir, multiplier=1.0, train_only=True):
    return ev.classify_intervals(
        scores(spark, sf_dir),
        "dep_delay_new",
        multiplier=multiplier,
        sigma_rows=_train() if train_only else None,
    )


@query("metric_mae", f"WITH {SCORES} SELECT round(avg(abs(dep_delay_new - prediction)), 6) AS mae FROM v_pred")
def metric_mae(spark, sf_dir):
    return ev.mean_absolute_error(scores(spark, sf_dir), "dep_delay_new").select(rounded("mae").alias("mae"))


@query("residual_stddev", f"WITH {SCORES} SELECT round({ALL_SIGMA}, 6) AS sigma")
def residual_stddev(spark, sf_dir):
    return ev.residual_stddev(scores(spark, sf_dir), "dep_delay_new").select(rounded("sigma").alias("sigma"))


@query(
    "interval_classify",
    f"""WITH {_intervals_sql(TRAIN_SIGMA)} SELECT flight_id, round(prediction, 9) AS prediction,
      round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound, predicted_delayed,
      predicted_interval_delayed, predicted_interval_delayed_binary,
      CASE WHEN predicted_interval_delayed = 2 THEN 'uncertain' ELSE 'high' END AS prediction_confidence
    FROM v_int""",
)
def interval_classify(spark, sf_dir):
    return _intervals(spark, sf_dir).select(
        "flight_id",
        rounded("prediction", 9).alias("prediction"),
        rounded("lower_bound").alias("lower_bound"),
        rounded("upper_bound").alias("upper_bound"),
        "predicted_delayed",
        "predicted_interval_delayed",
        "predicted_interval_delayed_binary",
        "prediction_confidence",
    )


@query(
    "confusion_counts",
    f"""WITH {_intervals_sql(TRAIN_SIGMA)} SELECT count(*) FILTER (predicted_delayed = 1 AND dep_del15 = 1) AS tp,
      count(*) FILTER (predicted_delayed = 1 AND dep_del15 = 0) AS fp,
      count(*) FILTER (predicted_delayed = 0 AND dep_del15 = 1) AS fn,
      count(*) FILTER (predicted_delayed = 0 AND dep_del15 = 0) AS tn FROM v_int""",
)
def confusion_counts(spark, sf_dir):
    return summaries.confusion_counts(_intervals(spark, sf_dir), "predicted_delayed", "dep_del15")


@query(
    "confusion_matrix",
    f"""WITH {_intervals_sql(TRAIN_SIGMA)}
    SELECT CASE dep_del15 WHEN 0 THEN 'actual_no' ELSE 'actual_yes' END AS actual,
      count(*) FILTER (predicted_delayed = 0) AS predicted_0,
      count(*) FILTER (predicted_delayed = 1) AS predicted_1 FROM v_int GROUP BY 1""",
)
def confusion_matrix(spark, sf_dir):
    matrix = summaries.confusion_matrix(_intervals(spark, sf_dir), "predicted_delayed", "dep_del15")
    return matrix.withColumn("actual", recode("actual", {"0": "actual_no", "1": "actual_yes"}))


@query(
    "confusion_prf2",
    f"WITH {_intervals_sql(TRAIN_SIGMA)}, {_prf_sql('v_int', 'predicted_delayed', 'dep_del15')} SELECT {PRF_OUT} FROM v_prf",
)
def confusion_prf2(spark, sf_dir):
    matrix = summaries.confusion_matrix(_intervals(spark, sf_dir), "predicted_delayed", "dep_del15")
    late = F.col("actual") == 1
    counts = matrix.agg(
        F.sum(F.when(late, F.col("predicted_1")).otherwise(0)).alias("tp"),
        F.sum(F.when(late, F.lit(0)).otherwise(F.col("predicted_1"))).alias("fp"),
        F.sum(F.when(late, F.col("predicted_0")).otherwise(0)).alias("fn"),
    )
    return _prf_columns(summaries.with_prf(counts))


@query(
    "count_by_pred_label",
    f"""WITH {_intervals_sql(TRAIN_SIGMA)} SELECT predicted_interval_delayed, dep_del15, count(*) AS n
    FROM v_int GROUP BY 1, 2""",
)
def count_by_pred_label(spark, sf_dir):
    intervals = _intervals(spark, sf_dir)
    return summaries.count_by(intervals, "predicted_interval_delayed", "dep_del15", name="n")


@query(
    "metrics_prf2",
    f"""WITH {_intervals_sql(TRAIN_SIGMA)},
    {_prf_sql('v_int', 'predicted_interval_delayed_binary', 'dep_del15')} SELECT {PRF_OUT} FROM v_prf""",
)
def metrics_prf2(spark, sf_dir):
    intervals = _intervals(spark, sf_dir)
    return _prf_columns(
        ev.precision_recall_fbeta(intervals, "predicted_interval_delayed_binary", "dep_del15")
    )


@query(
    "metrics_prf2_half_sigma",
    f"""WITH {_intervals_sql(ALL_SIGMA, 0.5)},
    v_late AS (SELECT *, CASE WHEN dep_delay_new >= 15 THEN 1 ELSE 0 END AS late FROM v_int),
    {_prf_sql('v_late', 'predicted_interval_delayed_binary', 'late')} SELECT {PRF_OUT} FROM v_prf""",
)
def metrics_prf2_half_sigma(spark, sf_dir):
    intervals = _intervals(spark, sf_dir, multiplier=0.5, train_only=False)
    labelled = intervals.withColumn("late", (F.col("dep_delay_new") >= 15).cast("int"))
    return _prf_columns(ev.precision_recall_fbeta(labelled, "predicted_interval_delayed_binary", "late"))


def _sweep_sql(start: float, stop: float, step: float) -> str:
    grid = ", ".join(f"({k!r}::DOUBLE)" for k in ev.multiplier_grid(start, stop, step))
    return f"""WITH {SCORES},
    v_s AS (SELECT prediction, dep_delay_new, {TRAIN_SIGMA} AS sigma FROM v_pred),
    v_k AS (SELECT k AS multiplier, CASE WHEN prediction + sigma * k >= 15 THEN 1 ELSE 0 END AS hit,
      CASE WHEN dep_delay_new >= 15 THEN 1 ELSE 0 END AS late FROM v_s, (VALUES {grid}) g(k)),
    {_prf_sql('v_k', 'hit', 'late', 'multiplier')} SELECT multiplier, {PRF_OUT} FROM v_prf"""


@query("sweep_sigma_multiplier", _sweep_sql(-2, 2, 0.2))
def sweep_sigma_multiplier(spark, sf_dir):
    grid = ev.multiplier_grid(-2, 2, 0.2)
    sweep = ev.sweep_multipliers(scores(spark, sf_dir), grid, "dep_delay_new", sigma_rows=_train())
    return _prf_columns(sweep, "multiplier")


@query("sweep_sigma_multiplier_fine", _sweep_sql(0, 0.6, 0.02))
def sweep_sigma_multiplier_fine(spark, sf_dir):
    grid = ev.multiplier_grid(0, 0.6, 0.02)
    sweep = ev.sweep_multipliers(scores(spark, sf_dir), grid, "dep_delay_new", sigma_rows=_train())
    return _prf_columns(sweep, "multiplier")


@query(
    "best_sigma_multiplier",
    _sweep_sql(-2, 2, 0.2) + " ORDER BY f DESC, multiplier LIMIT 1",
)
def best_sigma_multiplier(spark, sf_dir):
    grid = ev.multiplier_grid(-2, 2, 0.2)
    sweep = ev.sweep_multipliers(scores(spark, sf_dir), grid, "dep_delay_new", sigma_rows=_train())
    return _prf_columns(ev.best_multiplier(sweep), "multiplier")


@query(
    "metric_accuracy",
    f"""WITH {_intervals_sql(TRAIN_SIGMA)}
    SELECT round(avg(CASE WHEN predicted_delayed = dep_del15 THEN 1 ELSE 0 END), 6) AS accuracy_point,
      round(avg(CASE WHEN predicted_interval_delayed_binary = dep_del15 THEN 1 ELSE 0 END), 6) AS accuracy_interval
    FROM v_int""",
)
def metric_accuracy(spark, sf_dir):
    names = ["predicted_delayed", "predicted_interval_delayed_binary"]
    found = ev.accuracy(_intervals(spark, sf_dir), names, "dep_del15")
    return found.select(
        rounded(f"accuracy_{names[0]}").alias("accuracy_point"),
        rounded(f"accuracy_{names[1]}").alias("accuracy_interval"),
    )


AUC_SQL = f"""WITH {SCORES},
  v_rank AS (SELECT dep_del15, rank() OVER (ORDER BY prediction)
    + (count(*) OVER (PARTITION BY prediction) - 1) / 2.0 AS r FROM v_pred),
  v_n AS (SELECT sum(r) FILTER (dep_del15 = 1) AS s, count(*) FILTER (dep_del15 = 1) AS p,
    count(*) FILTER (dep_del15 = 0) AS n FROM v_rank)
  SELECT round((s - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * n), 6) AS auc, p AS positives, n AS negatives FROM v_n"""


@query("metric_auc", AUC_SQL)
def metric_auc(spark, sf_dir):
    area = ranking.roc_area(scores(spark, sf_dir), "prediction", "dep_del15")
    return area.select(rounded("auc").alias("auc"), "positives", "negatives")


def _label_rates_sql() -> str:
    return f"""{_intervals_sql(TRAIN_SIGMA)},
    v_l AS (SELECT l AS label, count(*) FILTER (dep_del15 = l) AS support,
        count(*) FILTER (predicted_delayed = l) AS predicted,
        count(*) FILTER (dep_del15 = l AND predicted_delayed = l) AS tp, count(*) AS total
      FROM v_int, (VALUES (0), (1)) v(l) GROUP BY l),
    v_rate AS (SELECT *, predicted - tp AS fp, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p,
      CASE WHEN support > 0 THEN tp / support ELSE 0 END AS tpr,
      CASE WHEN total > support THEN (predicted - tp) / (total - support) ELSE 0 END AS fpr FROM v_l)"""


@query(
    "metric_by_label",
    f"""WITH {_label_rates_sql()} SELECT label, support, tp, fp, round(p, 6) AS precision, round(tpr, 6) AS tpr,
      round(fpr, 6) AS fpr FROM v_rate""",
)
def metric_by_label(spark, sf_dir):
    rates = ev.by_label_rates(_intervals(spark, sf_dir), "predicted_delayed", "dep_del15")
    return rates.select(
        "label", "support", "tp", "fp", *[rounded(c).alias(c) for c in ("precision", "tpr", "fpr")]
    )


@query(
    "metric_weighted_pr",
    f"""WITH {_label_rates_sql()}, v_w AS (SELECT sum(p * support / total) AS wp, sum(tpr * support / total) AS wr,
      sum(fpr * support / total) AS wf, sum(CASE WHEN p + tpr > 0 THEN 2 * p * tpr / (p + tpr) ELSE 0 END
        * support / total) AS f1 FROM v_rate)
    SELECT round(wp, 6) AS weighted_precision, round(wr, 6) AS weighted_recall, round(wf, 6) AS weighted_fpr,
      round(f1, 6) AS weighted_f1, round(CASE WHEN 4 * wp + wr > 0 THEN 5 * wp * wr / (4 * wp + wr) ELSE 0 END, 6) AS f2
    FROM v_w""",
)
def metric_weighted_pr(spark, sf_dir):
    weighted = ev.weighted_metrics(_intervals(spark, sf_dir), "predicted_delayed", "dep_del15")
    names = ("weighted_precision", "weighted_recall", "weighted_fpr", "weighted_f1")
    return weighted.select(*[rounded(c).alias(c) for c in names], rounded("fbeta").alias("f2"))


@query(
    "metrics_high_confidence",
    f"""WITH {_intervals_sql(TRAIN_SIGMA, 0.5)},
    v_high AS (SELECT * FROM v_int WHERE predicted_interval_delayed <> 2),
    {_prf_sql('v_high', 'predicted_interval_delayed', 'dep_del15')}
    SELECT (SELECT count(*) FROM v_int) AS rows,
      round((SELECT count(*) FILTER (predicted_interval_delayed = 2) * 100.0 / count(*) FROM v_int), 6) AS uncertain_pct,
      round(coalesce((SELECT avg(CASE WHEN predicted_interval_delayed = dep_del15 THEN 1 ELSE 0 END) FROM v_high), 0), 6)
        AS accuracy, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f2 FROM v_prf""",
)
def metrics_high_confidence(spark, sf_dir):
    report = ev.confidence_report(_intervals(spark, sf_dir, multiplier=0.5), "dep_del15")
    return report.select(
        "rows",
        *[rounded(c).alias(c) for c in ("uncertain_pct", "accuracy", "precision", "recall")],
        rounded("fbeta").alias("f2"),
    )


@query(
    "metrics_by_split",
    f"""WITH {_intervals_sql(TRAIN_SIGMA)},
    {_prf_sql('v_int', 'predicted_interval_delayed_binary', 'dep_del15', 'part')},
    v_m AS (SELECT part, avg(abs(dep_delay_new - prediction)) AS mae FROM v_int GROUP BY part)
    SELECT part, round(mae, 6) AS mae, {PRF_OUT} FROM v_prf JOIN v_m USING (part)""",
)
def metrics_by_split(spark, sf_dir):
    found = ev.metrics_by_part(_intervals(spark, sf_dir), "dep_delay_new", "dep_del15")
    return _prf_columns(found, "part", rounded("mae").alias("mae"))
