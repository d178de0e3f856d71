"""Compiled pipelines against the fitted ones, row by row."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from delaywright.learning import compiled, models
from delaywright.learning.features import FeatureSpec
from tests.conftest import plan_text


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(6)
    found = [(i, draw.choice("abcde"), draw.randrange(4), draw.gauss(0, 9), draw.choice([1.0, 2.0, 5.0]), 7.0, draw.random()) for i in range(400)]
    frame = spark.createDataFrame(found, "id int, kind string, code int, x double, y double, flat double, r double")
    target = F.col("x") * 2 + F.when(F.col("kind") == "a", 9).otherwise(0) + F.col("r")
    return frame.withColumn("target", target).withColumn("late", (target > 5).cast("double")).withColumn("is_validation", F.col("id") % 7 == 0).cache()


def unknown(rows):
    """Rows that a pipeline skips, beside all others."""
    row = rows.limit(1)
    odd = [row.withColumn("kind", F.lit("zz")), row.withColumn("kind", F.lit(None).cast("string")), row.withColumn("x", F.lit(None).cast("double")), row.withColumn("x", F.lit(float("nan")))]
    for frame in odd:
        rows = rows.unionByName(frame)
    return rows


def apart(model, rows):
    expression = compiled.compile_model(model)
    mine = {r["id"]: r["prediction"] for r in expression.score(rows).select("id", "prediction").collect()}
    theirs = {r["id"]: r["prediction"] for r in model.transform(rows).select("id", "prediction").collect()}
    assert mine.keys() == theirs.keys() and expression.score(rows).count() == model.transform(rows).count()
    return max(abs(mine[k] - theirs[k]) for k in mine)


@pytest.mark.parametrize("one_hot, scaler", [(True, "minmax"), (False, "standard")])
def test_linear(rows, one_hot, scaler):
    spec = FeatureSpec(("kind", "code"), ("x", "y", "flat"), one_hot, scaler)
    model = models.reload(models.linear_pipeline(spec, "target").fit(rows), rows)
    assert apart(model, unknown(rows)) < 1e-9


def test_boosted_trees(rows):
    spec = FeatureSpec(("kind", "code"), ("x", "y", "flat"), False)
    model = models.boosted_pipeline(spec, "target", {"maxIter": 6, "maxDepth": 4}).fit(rows)
    assert apart(model, unknown(rows)) < 1e-9
    text = plan_text(compiled.compile_model(model).score(rows))
    assert "Python" not in text and "UDF" not in text


def test_perceptron(rows):
    spec = FeatureSpec(("kind",), ("x", "y"), False)
    model = models.fit_perceptron(spec, rows, "late", (4, 3))
    assert apart(model, unknown(rows)) == 0


def test_other_stages_are_an_error(rows):
    model = Pipeline(stages=[Bucketizer(splits=[-1e9, 0.0, 1e9], inputCol="x", outputCol="b")]).fit(rows)
    with pytest.raises(TypeError):
        compiled.compile_model(model)


def test_categories_of_a_linear_model_are_looked_up(rows):
    # forty categories in one column: a term for each would be too much generated code
    many = rows.withColumn("kind", (F.col("id") % 40).cast("string"))
    model = models.linear_pipeline(FeatureSpec(("kind",), ("x",), True), "target").fit(many)
    assert apart(model, unknown(many)) < 1e-9
    text = str(compiled.compile_model(model).prediction)
    assert text.count("_kind_indexed") <= 2
