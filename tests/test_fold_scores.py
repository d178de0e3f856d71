"""Search over folds against Spark's cross-validation."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from delaywright.learning import features as ft
from delaywright.learning import search
from delaywright.operators import splitting


@pytest.fixture(scope="module")
def rows(spark):
    kind = F.when(F.col("row_id") % 5 == 0, "a").otherwise("c")
    x = (F.col("row_id") % 17).cast("double")
    found = spark.range(200).withColumnRenamed("id", "row_id").select("row_id", kind.alias("c"), x.alias("x"))
    return found.withColumn("late", (F.col("x") + F.col("row_id") % 3 > 9).cast("double")).coalesce(1).cache()


# A block of one row: the size of blocks at the ends of partitions must not matter.
def test_scores_over_folds_fit_once_what_is_the_same(rows, monkeypatch):
    spec = ft.FeatureSpec(("c",), ("x",), one_hot=False)
    model = MultilayerPerceptronClassifier(featuresCol="features", labelCol="late", layers=[2, 3, 2], blockSize=1, seed=3)
    grid = ParamGridBuilder().addGrid(model.maxIter, [1, 30]).addGrid(model.stepSize, [0.01, 0.5]).build()
    judge = MulticlassClassificationEvaluator(labelCol="late")
    folds = splitting.hashed_folds(rows, "row_id", 3)
    whole = CrossValidator(estimator=Pipeline(stages=[*spec.stages(), model]), estimatorParamMaps=grid, evaluator=judge, numFolds=3, foldCol="fold").fit(folds)
    fits = {"stages": 0, "models": 0}
    for kind, name in ((Pipeline, "stages"), (MultilayerPerceptronClassifier, "models")):
        def counted(self, *given, _fit=kind.fit, _name=name):
            fits[_name] += 1
            return _fit(self, *given)
        monkeypatch.setattr(kind, "fit", counted)
    found = search.scores_over_folds(folds, "fold", 3, spec, model, grid, judge, (model.stepSize,))
    assert found == pytest.approx(whole.avgMetrics, abs=1e-6)
    assert fits == {"stages": 3, "models": 6}
    assert search.best_point(found, judge) == found.index(max(found))
