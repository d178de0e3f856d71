"""Feature pipelines, models and searches on the flight view."""

from __future__ import annotations

from functools import partial

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from delaywright.functions import expressions as fx
from delaywright.learning import features as ft
from delaywright.learning import compiled, least_squares, models, search
from delaywright.operators import cleaning, evaluation, joins, splitting, summaries
from delaywright.operators.feature_table import flight_features
from delaywright.plans.features import KNOWN_PRIOR
from delaywright.plans.registry import query
from delaywright.plans.views import FLIGHTS, WEATHER, flights, rounded, sql_rounded, station_lookup, station_reports, table
from delaywright.runtime import scratch_path

# Names of the features.
SPEC = ft.FeatureSpec(
    categorical=(
        "carrier",
        "origin",
        "dest",
        "crs_dep_time_part_of_day",
        "christmas_travel",
        "federal_holiday_indicator",
    ),
    numeric=(
        "crs_dep_hour_sin",
        "crs_dep_hour_cos",
        "crs_dep_day_of_year_sin",
        "crs_dep_day_of_year_cos",
        "tail_num_flight_seq_num",
        "parallel_flights",
        "prior_flight_dep_delay_new",
        "prior_flight_origin_delay_pagerank",
        "recency_days",
        "station_distance",
        "reading",
    ),
)
TREE_SPEC = ft.FeatureSpec(categorical=SPEC.categorical, numeric=SPEC.numeric, one_hot=False)
TARGET = "dep_delay_new"


def known_flights(spark, sf_dir):
    return cleaning.with_known_target(flights(spark, sf_dir), TARGET)


def model_rows(spark, sf_dir):
    """The feature table of all flights with a known target, with the weather at their airport."""
    featured = flight_features(known_flights(spark, sf_dir))
    stations, reports = station_lookup(spark, sf_dir), station_reports(spark, sf_dir)
    seen = joins.with_station_reports(
        featured, stations, reports, "origin", "dep_ts", "flight_id", "station", "report_ts", "report_id", ["reading"]
    )
    return ft.numeric_as_double(seen, SPEC.numeric)


def _parts(spark, sf_dir):
    """Train, validation and test parts; the cuts are found on the scan, not on the features."""
    cuts = splitting.chronological_cuts(
        known_flights(spark, sf_dir),
        "fl_date",
        "flight_id",
        lambda total: splitting.split_positions(total, 0.8, 0.7),
    )
    return splitting.label_parts(
        model_rows(spark, sf_dir), "fl_date", "flight_id", cuts, ["train", "validation", "test"]
    )


def _train_test(spark, sf_dir):
    parts = ft.cache_for_training(_parts(spark, sf_dir))
    return parts.filter(F.col("part") != "test"), parts.filter(F.col("part") == "test"), parts


# --- feature stages --------------------------------------------------------------------------------


@query(
    "ml_string_index",
    f"""WITH {FLIGHTS}, f AS (SELECT carrier, count(*) AS n FROM v_flight GROUP BY 1)
    SELECT flight_id, f.carrier, CAST(idx AS DOUBLE) AS carrier_indexed FROM v_flight v JOIN
      (SELECT carrier, row_number() OVER (ORDER BY n DESC, carrier) - 1 AS idx FROM f) f ON v.carrier = f.carrier""",
)
def ml_string_index(spark, sf_dir):
    rows = flights(spark, sf_dir).select("flight_id", "carrier")
    indexer = StringIndexer(
        inputCol="carrier", outputCol="carrier_indexed", handleInvalid="skip", stringOrderType="frequencyDesc"
    )
    return indexer.fit(rows).transform(rows)


@query(
    "ml_one_hot",
    f"""WITH {FLIGHTS}, f AS (SELECT carrier, count(*) AS n FROM v_flight GROUP BY 1),
    i AS (SELECT carrier, row_number() OVER (ORDER BY n DESC, carrier) - 1 AS idx, count(*) OVER () AS k FROM f)
    SELECT flight_id, CASE WHEN idx < k - 1 THEN idx ELSE -1 END AS hot_slot FROM v_flight v JOIN i ON v.carrier = i.carrier""",
)
def ml_one_hot(spark, sf_dir):
    rows = flights(spark, sf_dir).select("flight_id", "carrier")
    stages = [
        StringIndexer(inputCol="carrier", outputCol="idx", handleInvalid="skip"),
        OneHotEncoder(inputCol="idx", outputCol="vec"),
    ]
    encoded = Pipeline(stages=stages).fit(rows).transform(rows)
    slot = F.array_position(vector_to_array("vec"), F.lit(1.0)) - 1
    return encoded.select("flight_id", slot.cast("bigint").alias("hot_slot"))


SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


def _scaled(spark, sf_dir, scaler):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *SCALED)
    assembler = VectorAssembler(inputCols=SCALED, outputCol="raw", handleInvalid="skip")
    scaled = Pipeline(stages=[assembler, scaler]).fit(lines).transform(lines)
    values = scaled.withColumn("v", vector_to_array("scaled"))
    return values.select(
        "l_orderkey", "l_linenumber", "l_partkey", *[rounded(F.col("v")[i]).alias(c) for i, c in enumerate(SCALED)]
    )


@query(
    "ml_minmax",
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(
        sql_rounded(f"(l.{c} - s.lo_{c}) / (s.hi_{c} - s.lo_{c})") + f" AS {c}" for c in SCALED
    )
    + " FROM lineitem l, (SELECT "
    + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in SCALED)
    + " FROM lineitem) s",
)
def ml_minmax(spark, sf_dir):
    return _scaled(spark, sf_dir, MinMaxScaler(inputCol="raw", outputCol="scaled"))


@query(
    "ml_standardize",
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(sql_rounded(f"(l.{c} - s.m_{c}) / s.s_{c}") + f" AS {c}" for c in SCALED)
    + " FROM lineitem l, (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in SCALED)
    + " FROM lineitem) s",
)
def ml_standardize(spark, sf_dir):
    return _scaled(
        spark, sf_dir, StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True)
    )


# --- models ------------------------------------------------------------------------------------------


def _score_columns(scored):
    return scored.select("flight_id", "part", TARGET, F.round("prediction", 6).alias("prediction"))


def _report(scored, parts):
    """The model's report; the rows are few, so the training rows can be released at once."""
    report = evaluation.report_by_part(scored, parts, TARGET, "dep_del15")
    digits = ("sigma", "mae", "precision", "recall", "fbeta")
    rows = report.select("part", *[F.round(c, 6).alias(c) if c in digits else c for c in report.columns if c != "part"])
    found = rows.sparkSession.createDataFrame(rows.collect(), rows.schema)
    parts.unpersist()
    return found


@query("report_linear")
def report_linear(spark, sf_dir):
    """Linear model: predictions, intervals from the training residuals, metrics of every part."""
    train, _, parts = _train_test(spark, sf_dir)
    return _report(models.linear_pipeline(SPEC, TARGET).fit(train).transform(parts), parts)


@query("report_boosted")
def report_boosted(spark, sf_dir):
    """Boosted trees: predictions, intervals from the training residuals, metrics of every part."""
    train, _, parts = _train_test(spark, sf_dir)
    flagged = splitting.training_with_validation_flag(train)
    return _report(models.boosted_pipeline(TREE_SPEC, TARGET).fit(flagged).transform(parts), parts)


@query("report_perceptron")
def report_perceptron(spark, sf_dir):
    """Perceptron: confusion counts and weighted precision, recall and F1 of every part, and the
    rows it skipped."""
    train, _, parts = _train_test(spark, sf_dir)
    model = models.fit_perceptron(TREE_SPEC, _late(train), "sign_delay")
    scored = model.transform(_late(parts)).select("part", "sign_delay", "prediction")
    given = parts.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    counts = summaries.confusion_counts(scored, "prediction", "sign_delay", ["part"])
    weighted = _weighted(counts)
    report = given.join(weighted, "part", "left").withColumn(
        "skipped", F.col("rows") - F.coalesce(F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"), F.lit(0))
    )
    found = spark.createDataFrame(report.collect(), report.schema)
    parts.unpersist()
    return found


def _weighted(counts):
    """Precision, recall and F1 of both classes, weighted by the classes' rows, from the counts."""
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    classes = (("tp", "fp", "fn"), ("tn", "fn", "fp"))
    found = {"weighted_precision": F.lit(0.0), "weighted_recall": F.lit(0.0), "weighted_f1": F.lit(0.0)}
    for hit, false, missed in classes:
        weight = (F.col(hit) + F.col(missed)) / n
        precision = fx.safe_ratio(F.col(hit), F.col(hit) + F.col(false))
        recall = fx.safe_ratio(F.col(hit), F.col(hit) + F.col(missed))
        found["weighted_precision"] += weight * precision
        found["weighted_recall"] += weight * recall
        found["weighted_f1"] += weight * fx.safe_ratio(precision * recall * 2, precision + recall)
    return counts.select("*", *[F.round(c, 6).alias(name) for name, c in found.items()])


@query("ml_linear_regression")
def ml_linear_regression(spark, sf_dir):
    train, _, parts = _train_test(spark, sf_dir)
    return _score_columns(models.linear_pipeline(SPEC, TARGET).fit(train).transform(parts))


@query("ml_linear_elastic")
def ml_linear_elastic(spark, sf_dir):
    train, _, parts = _train_test(spark, sf_dir)
    spec = ft.FeatureSpec(SPEC.categorical, SPEC.numeric, one_hot=False, scaler="standard")
    pipeline = models.linear_pipeline(spec, TARGET, models.LINEAR_ELASTIC)
    return _score_columns(pipeline.fit(train).transform(parts))


@query("ml_coefficients")
def ml_coefficients(spark, sf_dir):
    train, _, parts = _train_test(spark, sf_dir)
    model = models.linear_pipeline(SPEC, TARGET).fit(train)
    return models.coefficients(model, model.transform(parts)).orderBy("slot")


@query("ml_l1_select")
def ml_l1_select(spark, sf_dir):
    train, _, parts = _train_test(spark, sf_dir)
    pipeline = models.linear_pipeline(SPEC, TARGET, {"regParam": 0.1, "elasticNetParam": 1.0})
    model = pipeline.fit(train)
    return models.selected_features(model, model.transform(parts)).orderBy("slot")


@query("ml_gbt")
def ml_gbt(spark, sf_dir):
    train, _, parts = _train_test(spark, sf_dir)
    flagged = splitting.training_with_validation_flag(train)
    model = models.boosted_pipeline(TREE_SPEC, TARGET).fit(flagged)
    return _score_columns(model.transform(parts))


@query("ml_gbt_tuned")
def ml_gbt_tuned(spark, sf_dir):
    train, _, parts = _train_test(spark, sf_dir)
    flagged = splitting.training_with_validation_flag(train)
    model = models.boosted_pipeline(TREE_SPEC, TARGET, models.BOOSTED_TUNED).fit(flagged)
    return _score_columns(model.transform(parts))


@query("ml_importances")
def ml_importances(spark, sf_dir):
    train, _, parts = _train_test(spark, sf_dir)
    flagged = splitting.training_with_validation_flag(train)
    model = models.boosted_pipeline(TREE_SPEC, TARGET, models.BOOSTED_TUNED).fit(flagged)
    return models.importances(model, model.transform(parts)).orderBy(F.desc("value"), "slot")


def _late(df):
    return df.withColumn("sign_delay", fx.delay_flag("dep_delay", 60, inclusive=False).cast("double"))


@query("ml_mlp")
def ml_mlp(spark, sf_dir):
    train, _, parts = _train_test(spark, sf_dir)
    model = models.fit_perceptron(TREE_SPEC, _late(train), "sign_delay")
    return model.transform(_late(parts)).select("flight_id", "part", "sign_delay", "prediction")


@query(
    "model_roundtrip_score",
    f"""WITH {FLIGHTS}, {KNOWN_PRIOR}, {WEATHER},
    n AS (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) AS upto FROM v_flight),
    p AS (SELECT flight_id, row_number() OVER (ORDER BY fl_date, flight_id) AS pos FROM v_flight)
    SELECT CASE WHEN pos <= CAST(floor(upto * 0.7) AS BIGINT) THEN 'train' WHEN pos <= upto THEN 'validation'
      ELSE 'test' END AS part, count(*) AS scored, 0.0 AS largest_difference
    FROM p JOIN known USING (flight_id) JOIN v_weather USING (flight_id), n
    WHERE d IS NOT NULL AND reading IS NOT NULL GROUP BY 1""",
)
def model_roundtrip_score(spark, sf_dir):
    """A saved and reloaded model as a column expression, held against the fitted one: rows scored
    and the largest difference of both predictions, by part."""
    train, _, parts = _train_test(spark, sf_dir)
    model = models.linear_pipeline(SPEC, TARGET).fit(train)
    both = model.transform(compiled.compile_model(models.reload(model, train)).score(parts, "compiled"))
    apart = F.max(F.abs(F.col("prediction") - F.col("compiled")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("scored"), F.round(apart, 6).alias("largest_difference"))


@query("ml_boosted_expression")
def ml_boosted_expression(spark, sf_dir):
    """Boosted trees scored by one column expression."""
    train, _, parts = _train_test(spark, sf_dir)
    model = models.boosted_pipeline(TREE_SPEC, TARGET).fit(splitting.training_with_validation_flag(train))
    return _score_columns(compiled.compile_model(model).score(parts))


# --- exact regressions -----------------------------------------------------------------------------

REGRESSORS = ["crs_dep_hour", "day_of_week"]
_X = """v_x AS (SELECT flight_id, fl_date, CAST(floor(crs_dep_time / 100) AS INTEGER) AS crs_dep_hour,
      CAST(isodow(fl_date) AS INTEGER) AS day_of_week, dep_delay_new AS y FROM v_flight),
    v_pos AS (SELECT *, row_number() OVER (ORDER BY fl_date, flight_id) AS pos FROM v_x)"""
#: Means and co-moments of both regressors and the target, and the solution of the normal equations.
_MOMENTS = """avg(crs_dep_hour) AS m1, avg(day_of_week) AS m2, avg(y) AS my, var_pop(crs_dep_hour) AS v1,
      var_pop(day_of_week) AS v2, covar_pop(crs_dep_hour, day_of_week) AS c, covar_pop(crs_dep_hour, y) AS c1,
      covar_pop(day_of_week, y) AS c2"""
_SOLVED = """((v2 + ridge) * c1 - c * c2) / ((v1 + ridge) * (v2 + ridge) - c * c) AS w1,
      ((v1 + ridge) * c2 - c * c1) / ((v1 + ridge) * (v2 + ridge) - c * c) AS w2"""


def _regressors(spark, sf_dir):
    return flights(spark, sf_dir).select(
        "flight_id",
        "fl_date",
        fx.clock_hour("crs_dep_time").alias("crs_dep_hour"),
        fx.day_of_week("fl_date").alias("day_of_week"),
        TARGET,
    )


@query(
    "ols_single",
    f"""WITH {FLIGHTS}, {_X}
    SELECT CAST(0 AS INTEGER) AS slot, 'intercept' AS name, round(regr_intercept(y, crs_dep_hour), 8) AS value FROM v_x
    UNION ALL SELECT 1, 'crs_dep_hour', round(regr_slope(y, crs_dep_hour), 8) FROM v_x""",
)
def ols_single(spark, sf_dir):
    """Least squares on one feature, by moments."""
    rows = _regressors(spark, sf_dir)
    model = least_squares.fit(least_squares.moments(rows, REGRESSORS[:1], TARGET)[0])
    return least_squares.fit_rows(rows, model, REGRESSORS[:1]).withColumn("value", rounded("value", 8))


@query(
    "ols_exact",
    f"""WITH {FLIGHTS}, {_X}, m AS (SELECT {_MOMENTS}, 0 AS ridge FROM v_x), w AS (SELECT *, {_SOLVED} FROM m)
    SELECT CAST(0 AS INTEGER) AS slot, 'intercept' AS name, round(my - w1 * m1 - w2 * m2, 8) AS value FROM w
    UNION ALL SELECT 1, 'crs_dep_hour', round(w1, 8) FROM w UNION ALL SELECT 2, 'day_of_week', round(w2, 8) FROM w""",
)
def ols_exact(spark, sf_dir):
    """Least squares on several features: the normal equations, in one pass over the rows."""
    rows = _regressors(spark, sf_dir)
    model = least_squares.fit(least_squares.moments(rows, REGRESSORS, TARGET)[0])
    return least_squares.fit_rows(rows, model, REGRESSORS).withColumn("value", rounded("value", 8))


@query(
    "ols_predict",
    f"""WITH {FLIGHTS}, {_X}, m AS (SELECT {_MOMENTS}, 0 AS ridge FROM v_x), w AS (SELECT *, {_SOLVED} FROM m)
    SELECT flight_id, round(my + w1 * (crs_dep_hour - m1) + w2 * (day_of_week - m2), 6) AS prediction FROM v_x, w""",
)
def ols_predict(spark, sf_dir):
    """The exact model applied as a column expression."""
    rows = _regressors(spark, sf_dir)
    model = least_squares.fit(least_squares.moments(rows, REGRESSORS, TARGET)[0])
    return rows.select("flight_id", rounded(model.prediction(REGRESSORS)).alias("prediction"))


def _ridge_folds_sql(train_start: str) -> str:
    return f"""WITH {FLIGHTS}, {_X},
    s AS (SELECT count(*) AS n, count(*) // 3 AS tr, count(*) // 10 AS te FROM v_flight),
    f AS (SELECT CAST(i + 1 AS INTEGER) AS fold, {train_start} AS a, i * te + tr AS b, i * te + tr + te AS c
      FROM s, range(0, (SELECT (n - tr - te) // te FROM s)) t(i)),
    m AS (SELECT fold, {_MOMENTS} FROM f JOIN v_pos ON pos BETWEEN a AND b GROUP BY fold),
    w AS (SELECT *, {_SOLVED} FROM m, (VALUES (0.0), (1.0), (100.0)) p(ridge)),
    e AS (SELECT w.fold, ridge, sqrt(avg(pow(y - my - w1 * (crs_dep_hour - m1) - w2 * (day_of_week - m2), 2))) AS rmse
      FROM w JOIN f ON f.fold = w.fold JOIN v_pos ON pos BETWEEN f.b + 1 AND f.c GROUP BY w.fold, ridge),
    r AS (SELECT fold, ridge, 'intercept' AS name, my - w1 * m1 - w2 * m2 AS value FROM w
      UNION ALL SELECT fold, ridge, 'crs_dep_hour', w1 FROM w UNION ALL SELECT fold, ridge, 'day_of_week', w2 FROM w
      UNION ALL SELECT fold, ridge, 'rmse', rmse FROM e)
    SELECT fold, CAST(ridge AS DOUBLE) AS ridge, 0.0 AS l1, name, round(value, 6) AS value FROM r"""


RIDGES = [(0.0, 0.0), (1.0, 0.0), (100.0, 0.0)]


def _ridge_folds(spark, sf_dir, make_folds):
    rows = _regressors(spark, sf_dir)
    folds = make_folds(splitting.total_rows(rows))
    found = search.moments_over_folds(rows, "fl_date", "flight_id", folds, REGRESSORS, TARGET, RIDGES)
    return found.withColumn("value", rounded("value"))


@query("tune_ridge_sliding", _ridge_folds_sql("i * te + 1"))
def tune_ridge_sliding(spark, sf_dir):
    """Ridge regressions of a grid on sliding time folds, from one pass over the rows."""
    return _ridge_folds(spark, sf_dir, splitting.sliding_folds)


@query("tune_ridge_expanding", _ridge_folds_sql("CAST(1 AS BIGINT)"))
def tune_ridge_expanding(spark, sf_dir):
    """The same on folds whose training starts at the first row."""
    return _ridge_folds(spark, sf_dir, splitting.expanding_folds)


# --- search ----------------------------------------------------------------------------------------------


def _linear(params, features="features"):
    return LinearRegression(
        featuresCol=features, labelCol=TARGET, solver="l-bfgs", maxIter=100, standardization=False, **params
    )


@query("tune_grid_timefold")
def tune_grid_timefold(spark, sf_dir):
    rows = ft.cache_for_training(model_rows(spark, sf_dir))
    known = known_flights(spark, sf_dir)
    folds = splitting.sliding_folds(splitting.total_rows(known))
    predicates = splitting.fold_predicates(known, "fl_date", "flight_id", folds)
    spec = ft.FeatureSpec(SPEC.categorical, SPEC.numeric, one_hot=False, scaler="standard")
    cells = search.grid_over_folds(rows, predicates, spec, _linear, search.LINEAR_GRID, TARGET)
    rows.unpersist()
    return search.grid_summary(cells)


def _prepared(spec, train, *frames):
    """Fit the feature stages once and cache the prepared rows that all trials share."""
    stages = Pipeline(stages=spec.stages()).fit(train)
    return [ft.cache_for_training(stages.transform(f)) for f in (train, *frames)]


def _boosted_trial(train_x, test_x, trial):
    model = GBTRegressor(
        featuresCol="features",
        labelCol=TARGET,
        lossType="absolute",
        minInfoGain=0.01,
        validationIndicatorCol="is_validation",
        seed=7,
        **trial.params,
    ).fit(train_x)
    parts = [x.withColumn("part", F.lit(n)) for n, x in (("train", train_x), ("test", test_x))]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True)
    report = evaluation.report_by_part(model.transform(both), both, TARGET, "dep_del15")
    metrics = {
        f"{row['part']}_{name}": row[name] for row in report.collect() for name in ("mae", "precision", "recall", "fbeta")
    }
    # The loss that the search compares, the trial's importances, and where its model lies.
    path = scratch_path(train_x.sparkSession, f"model-{trial.run_id}")
    model.save(path)
    weights = {f"importance_{i}": v for i, v in enumerate(model.featureImportances.toArray().tolist()) if v}
    return {"loss": metrics["test_mae"], **metrics, **weights, "model": path}


@query("tune_random")
def tune_random(spark, sf_dir):
    train, test, parts = _train_test(spark, sf_dir)
    flagged = splitting.training_with_validation_flag(train)
    train_x, test_x = _prepared(TREE_SPEC, flagged, test)
    trials = search.draw_trials(search.BOOSTED_SPACE, 4, seed=11)
    rows = search.run_trials(spark, trials, partial(_boosted_trial, train_x, test_x))
    for frame in (train_x, test_x, parts):
        frame.unpersist()
    return search.run_rows(spark, rows)


def _perceptron_trial(width, train_x, test_x, trial):
    params = dict(trial.params)
    layers = [width, *params.pop("hidden"), 2]
    model = MultilayerPerceptronClassifier(
        featuresCol="features", labelCol="sign_delay", layers=layers, seed=1234, **params
    ).fit(train_x)
    found = {}
    for name, rows in (("train", train_x), ("test", test_x)):
        weighted = _weighted(summaries.confusion_counts(model.transform(rows), "prediction", "sign_delay")).first()
        found |= {f"{name}_{m}": weighted[f"weighted_{m}"] for m in ("precision", "recall", "f1")}
    return {"loss": -found["test_recall"], **found}


@query("tune_mlp")
def tune_mlp(spark, sf_dir):
    """Random search over perceptrons: the feature stages are fitted once, and what the hundreds of
    steps of all trials read are their vectors and labels alone."""
    used = [*TREE_SPEC.categorical, *TREE_SPEC.numeric]
    parts = _late(_parts(spark, sf_dir)).select(*used, "sign_delay", "part").persist(StorageLevel.MEMORY_AND_DISK)
    train, test = parts.filter(F.col("part") != "test"), parts.filter(F.col("part") == "test")
    stages = Pipeline(stages=TREE_SPEC.stages()).fit(train)
    ready = [stages.transform(x) for x in (train, test)]
    width = ft.vector_width(ready[0], "assembled_features")
    train_x, test_x = (ft.cache_for_steps(x.select("features", "sign_delay")) for x in ready)
    parts.unpersist()
    trials = search.draw_trials(search.PERCEPTRON_SPACE, 8, seed=11)
    trial = partial(_perceptron_trial, width, train_x, test_x)
    rows = search.run_trials(spark, trials, trial, search.trials_at_once(train_x))
    for frame in (train_x, test_x):
        frame.unpersist()
    return search.run_rows(spark, rows)


@query("cv_random")
def cv_random(spark, sf_dir):
    """3-fold search over the whole pipeline: indexers and scalers are fitted inside each fold. The
    best pipeline is kept and scored on the training and the test part."""
    train, test, parts = _train_test(spark, sf_dir)
    late = _late(train)
    prepared = Pipeline(stages=TREE_SPEC.stages()).fit(late)
    ready = prepared.transform(late)
    # Hidden layers and grid of the search.
    mlp = MultilayerPerceptronClassifier(
        featuresCol="features", labelCol="sign_delay", layers=[ft.vector_width(ready, "assembled_features"), 5, 4, 2], seed=1234
    )
    grid = (
        ParamGridBuilder()
        .addGrid(mlp.maxIter, [10, 50, 100])
        .addGrid(mlp.stepSize, [0.01, 0.1, 0.5])
        .build()
    )
    judge = MulticlassClassificationEvaluator(labelCol="sign_delay")
    folds = splitting.hashed_folds(late, "flight_id", 3)
    scores = search.scores_over_folds(folds, "fold", 3, TREE_SPEC, mlp, grid, judge, same_without=_unread(mlp))
    rows = []
    for i, (point, score) in enumerate(zip(grid, scores, strict=True)):
        rows += [(f"point-{i + 1}", "param", p.name, str(v)) for p, v in point.items()]
        rows.append((f"point-{i + 1}", "metric", "f1", repr(float(score))))
    best = PipelineModel(stages=[*prepared.stages, mlp.fit(ready, grid[search.best_point(scores, judge)])])
    path = scratch_path(spark, "model-cv")
    best.save(path)
    rows.append(("best", "model", "path", path))
    for name, part in (("train", train), ("test", test)):
        scored = best.transform(_late(part)).select("sign_delay", "prediction").persist()
        for metric in ("weightedRecall", "weightedTruePositiveRate", "weightedFMeasure"):
            value = judge.copy({judge.metricName: metric}).evaluate(scored)
            rows.append(("best", "metric", f"{name}_{metric}", repr(float(value))))
        scored.unpersist()
    parts.unpersist()
    return search.run_rows(spark, rows)


def _unread(mlp):
    """Parameters that the perceptron's solver does not read: the step size is gradient descent's."""
    return () if mlp.getSolver() == "gd" else (mlp.stepSize,)


@query("run_log_rows")
def run_log_rows(spark, sf_dir):
    """Two fits recorded with parameters, metrics and coefficients, appended to one run table."""
    train, test, _ = _train_test(spark, sf_dir)
    path = scratch_path(spark, "runs")
    flagged = splitting.training_with_validation_flag(train)
    for name, params in (("baseline", models.LINEAR_BASELINE), ("elastic", models.LINEAR_ELASTIC)):
        model = models.linear_pipeline(TREE_SPEC, TARGET, params).fit(flagged)
        scored = model.transform(test)
        rows = [(name, "param", k, str(v)) for k, v in params.items()]
        rows.append((name, "metric", "test_mae", repr(search.mean_absolute_error(scored, TARGET))))
        rows.append((name, "model", "path", models.save_model(model, scratch_path(spark, f"model-{name}"))))
        weights = models.coefficients(model, scored).select(
            F.lit(name).alias("run_id"),
            F.lit("coefficient").alias("kind"),
            F.col("feature").alias("name"),
            F.col("value").cast("string").alias("value"),
        )
        search.append_runs(search.run_rows(spark, rows).unionByName(weights), path)
    return spark.read.schema(search.RUN_SCHEMA).parquet(path)
