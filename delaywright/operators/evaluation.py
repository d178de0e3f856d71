"""Regression and interval-classification metrics, each from a single pass over the scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaywright.functions.expressions import DELAY_MINUTES, safe_ratio
from delaywright.operators.summaries import confusion_counts, with_prf


def residual_stddev(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Sample standard deviation of ``label - prediction`` as a one-row frame."""
    return df.agg(F.stddev_samp(F.col(label) - F.col(prediction)).alias("sigma"))


def mean_absolute_error(
    df: DataFrame, label: str, prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.abs(F.col(label) - F.col(prediction))).alias("mae"))


def with_intervals(
    df: DataFrame,
    sigma: Column | float,
    prediction: str = "prediction",
    threshold: float = DELAY_MINUTES,
    multiplier: float = 1.0,
) -> DataFrame:
    """Interval ``prediction ∓ multiplier·sigma`` and the classes that follow from it.

    ``predicted_interval_delayed`` is 1 when even the lower bound reaches the threshold, 0 when
    not even the upper bound does, and 2 (uncertain) otherwise.
    """
    spread = (F.lit(sigma) if isinstance(sigma, (int, float)) else sigma) * multiplier
    value = F.col(prediction)
    bounded = df.select(
        "*", (value - spread).alias("lower_bound"), (value + spread).alias("upper_bound")
    )
    low, high = F.col("lower_bound"), F.col("upper_bound")
    interval = F.when(low >= threshold, 1.0).when(high < threshold, 0.0).otherwise(2.0)
    return bounded.select(
        "*",
        F.when(value >= threshold, 1.0).otherwise(0.0).alias("predicted_delayed"),
        interval.alias("predicted_interval_delayed"),
        F.when(high >= threshold, 1.0).otherwise(0.0).alias("predicted_interval_delayed_binary"),
        F.when(interval == 2.0, "uncertain").otherwise("high").alias("prediction_confidence"),
    )


def classify_intervals(
    df: DataFrame,
    label: str,
    prediction: str = "prediction",
    threshold: float = DELAY_MINUTES,
    multiplier: float = 1.0,
    sigma_rows: Column | None = None,
) -> DataFrame:
    """``with_intervals`` with sigma taken from the rows in ``sigma_rows``.

    Pass the training rows to keep test residuals out of the interval; None uses all rows.
    Sigma is a scalar subquery, so nothing is collected.
    """
    source = df if sigma_rows is None else df.filter(sigma_rows)
    sigma = residual_stddev(source, label, prediction).scalar()
    with_sigma = df.withColumn("sigma", sigma)
    return with_intervals(with_sigma, F.col("sigma"), prediction, threshold, multiplier)


def precision_recall_fbeta(
    df: DataFrame, predicted: str, actual: str, beta: float = 2.0, by: Sequence[str] = ()
) -> DataFrame:
    return with_prf(confusion_counts(df, predicted, actual, by), beta)


def accuracy(df: DataFrame, predicted: Sequence[str], actual: str) -> DataFrame:
    """Share of right predictions for several prediction columns, side by side."""
    right = [F.avg((F.col(p) == F.col(actual)).cast("double")).alias(f"accuracy_{p}") for p in predicted]
    return df.agg(*right)


def by_label_rates(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Support, precision, true- and false-positive rate of every class."""
    pairs = df.groupBy(
        F.col(actual).cast("int").alias("a"), F.col(predicted).cast("int").alias("p")
    ).agg(F.count(F.lit(1)).alias("n"))
    views = F.array(
        F.struct(F.col("a").alias("label"), F.lit("actual").alias("kind")),
        F.struct(F.col("p").alias("label"), F.lit("predicted").alias("kind")),
    )
    # each class pair contributes to the class it belongs to and to the class it was put into
    sided = pairs.select("n", (F.col("a") == F.col("p")).alias("hit"), F.inline(views))
    actual_side = F.col("kind") == "actual"
    counted = sided.groupBy("label").agg(
        F.sum(F.when(actual_side, F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~actual_side, F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when(actual_side & F.col("hit"), F.col("n")).otherwise(0)).alias("tp"),
    )
    everything = Window.partitionBy()  # one row per class
    total = F.sum("support").over(everything)
    return counted.select(
        "label",
        "support",
        "tp",
        (F.col("predicted") - F.col("tp")).alias("fp"),
        total.alias("total"),
        safe_ratio("tp", "predicted").alias("precision"),
        safe_ratio("tp", "support").alias("tpr"),
        safe_ratio(F.col("predicted") - F.col("tp"), total - F.col("support")).alias("fpr"),
    )


def weighted_metrics(df: DataFrame, predicted: str, actual: str, beta: float = 2.0) -> DataFrame:
    """Class metrics weighted by support, and F-beta of the weighted precision and recall."""
    rates = by_label_rates(df, predicted, actual)
    weight = F.col("support") / F.col("total")
    f1 = safe_ratio(F.col("precision") * F.col("tpr") * 2, F.col("precision") + F.col("tpr"))
    summed = rates.agg(
        F.sum(F.col("precision") * weight).alias("weighted_precision"),
        F.sum(F.col("tpr") * weight).alias("weighted_recall"),
        F.sum(F.col("fpr") * weight).alias("weighted_fpr"),
        F.sum(f1 * weight).alias("weighted_f1"),
    )
    p, r = F.col("weighted_precision"), F.col("weighted_recall")
    return summed.withColumn("fbeta", safe_ratio(p * r * (1 + beta * beta), p * (beta * beta) + r))


def confidence_report(intervals: DataFrame, actual: str) -> DataFrame:
    """Share of uncertain rows, and metrics on the high-confidence rows only."""
    sure = F.col("prediction_confidence") == "high"
    p, a = F.col("predicted_interval_delayed"), F.col(actual)
    counted = intervals.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~sure).alias("uncertain_rows"),
        F.count_if(sure & (p == a)).alias("right"),
        F.count_if(sure & (p == 1) & (a == 1)).alias("tp"),
        F.count_if(sure & (p == 1) & (a == 0)).alias("fp"),
        F.count_if(sure & (p == 0) & (a == 1)).alias("fn"),
    )
    measured = with_prf(counted)
    return measured.select(
        "rows",
        safe_ratio(F.col("uncertain_rows") * 100, F.col("rows")).alias("uncertain_pct"),
        safe_ratio("right", F.col("rows") - F.col("uncertain_rows")).alias("accuracy"),
        "precision",
        "recall",
        "fbeta",
    )


def multiplier_grid(start: float, stop: float, step: float) -> list[float]:
    """Evenly spaced multipliers including both ends, free of accumulated rounding."""
    count = round((stop - start) / step)
    return [round(start + i * step, 10) for i in range(count + 1)]


def sweep_multipliers(
    df: DataFrame,
    multipliers: Sequence[float],
    label: str,
    prediction: str = "prediction",
    threshold: float = DELAY_MINUTES,
    sigma_rows: Column | None = None,
) -> DataFrame:
    """Precision, recall and F2 for every multiplier of sigma, in one pass over the scores.

    A larger multiplier only turns more rows into "delayed". So each row is reduced to the number
    of multipliers that do not reach the threshold, the rows are counted by that number and the
    label, and the figures of each multiplier are running totals over those few counts.
    """
    ks = sorted(multipliers)
    source = df if sigma_rows is None else df.filter(sigma_rows)
    sigma = residual_stddev(source, label, prediction).scalar()
    placed = df.select(
        F.col(prediction).alias("_p"), (F.col(label) >= threshold).alias("late")
    ).withColumn("_s", sigma)
    misses = F.lit(0)
    for k in ks:
        misses = misses + (F.col("_p") + F.col("_s") * F.lit(k) < threshold).cast("int")
    counted = placed.groupBy(misses.alias("first_hit"), "late").agg(F.count(F.lit(1)).alias("n"))
    grid = F.array(
        *[F.struct(F.lit(i).alias("at"), F.lit(float(k)).alias("multiplier")) for i, k in enumerate(ks)]
    )
    # at most (multipliers + 1) * 2 counts, repeated per multiplier
    expanded = counted.select("first_hit", "late", "n", F.inline(grid))
    hit = F.col("first_hit") <= F.col("at")
    tallied = expanded.groupBy("multiplier").agg(
        F.sum(F.when(hit & F.col("late"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit & ~F.col("late"), F.col("n")).otherwise(0)).alias("fp"),
        F.sum(F.when(~hit & F.col("late"), F.col("n")).otherwise(0)).alias("fn"),
    )
    return with_prf(tallied)


def best_multiplier(sweep: DataFrame) -> DataFrame:
    """The multiplier with the highest F2; the smallest one on ties."""
    return sweep.orderBy(F.desc("fbeta"), F.asc("multiplier")).limit(1)


def metrics_by_part(
    df: DataFrame, label: str, actual: str, part: str = "part", prediction: str = "prediction"
) -> DataFrame:
    """Rows, MAE, confusion counts and interval metrics per split part, from one aggregate."""
    p, a = F.col("predicted_interval_delayed_binary"), F.col(actual)
    counted = df.groupBy(part).agg(
        F.avg(F.abs(F.col(label) - F.col(prediction))).alias("mae"),
        F.count_if((p == 1) & (a == 1)).alias("tp"),
        F.count_if((p == 1) & (a == 0)).alias("fp"),
        F.count_if((p == 0) & (a == 1)).alias("fn"),
        F.count_if((p == 0) & (a == 0)).alias("tn"),
    )
    return with_prf(counted)


def report_by_part(
    scored: DataFrame,
    every: DataFrame,
    label: str,
    actual: str,
    part: str = "part",
    train: str = "train",
    prediction: str = "prediction",
    multiplier: float = 1.0,
) -> DataFrame:
    """From a model's predictions to its report, one row per part: scored and skipped rows, sigma
    of the training residuals, MAE, confusion counts, precision, recall and F2 of the interval
    classes.

    ``every`` holds the rows the model was given (with ``part``); a model skips rows with unknown
    features, and the report says how many.
    """
    classes = with_sigma_of(scored, label, F.col(part) == train, prediction, multiplier)
    measured = metrics_by_part(classes, label, actual, part, prediction).join(
        classes.groupBy(part).agg(F.count(F.lit(1)).alias("scored"), F.first("sigma").alias("sigma")), part
    )
    given = every.groupBy(part).agg(F.count(F.lit(1)).alias("rows"))
    found = given.join(measured, part, "left").withColumn("scored", F.coalesce("scored", F.lit(0)))
    return found.withColumn("skipped", F.col("rows") - F.col("scored"))


def with_sigma_of(
    scored: DataFrame, label: str, rows: Column, prediction: str = "prediction", multiplier: float = 1.0
) -> DataFrame:
    """Interval classes with sigma taken from ``rows``; sigma is the one figure collected."""
    sigma = residual_stddev(scored.filter(rows), label, prediction).first()[0]
    return with_intervals(
        scored.withColumn("sigma", F.lit(sigma).cast("double")), F.col("sigma"), prediction, multiplier=multiplier
    )
