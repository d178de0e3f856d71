"""Models of the delay target: fitting, reading their parameters, saving and scoring.

All fitting is Spark ML's distributed training. Only model parameters (coefficients,
importances) are turned into small frames on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame

from delaywright.learning.features import FeatureSpec, vector_names, vector_width
from delaywright.runtime import scratch_path

# The published training settings.
LINEAR_BASELINE = {"regParam": 0.01, "elasticNetParam": 0.0}
LINEAR_ELASTIC = {"regParam": 0.1, "elasticNetParam": 0.5}
BOOSTED_BASELINE = {
    "maxIter": 100,
    "maxDepth": 7,
    "maxBins": 256,
    "minInstancesPerNode": 100,
    "minInfoGain": 0.01,
    "stepSize": 0.1,
}
BOOSTED_TUNED = {**BOOSTED_BASELINE, "maxIter": 56, "maxDepth": 5, "maxBins": 128, "minInstancesPerNode": 38}
PERCEPTRON_HIDDEN = (5, 4)
PERCEPTRON = {"maxIter": 10, "blockSize": 128, "seed": 1234}


def linear_pipeline(spec: FeatureSpec, target: str, params: Mapping[str, Any] = LINEAR_BASELINE) -> Pipeline:
    """Linear regression by L-BFGS; features are scaled before, so not again inside."""
    model = LinearRegression(
        featuresCol=spec.output, labelCol=target, solver="l-bfgs", standardization=False, **params
    )
    return Pipeline(stages=[*spec.stages(), model])


def boosted_pipeline(
    spec: FeatureSpec,
    target: str,
    params: Mapping[str, Any] = BOOSTED_BASELINE,
    validation: str | None = "is_validation",
    seed: int = 7,
) -> Pipeline:
    """Boosted trees with absolute loss; ``validation`` marks the rows for early stopping."""
    model = GBTRegressor(
        featuresCol=spec.output, labelCol=target, lossType="absolute", seed=seed, **params
    )
    if validation:
        model = model.setValidationIndicatorCol(validation)
    return Pipeline(stages=[*spec.stages(), model])


def fit_perceptron(
    spec: FeatureSpec,
    train: DataFrame,
    target: str,
    hidden: tuple[int, ...] = PERCEPTRON_HIDDEN,
    classes: int = 2,
    params: Mapping[str, Any] = PERCEPTRON,
) -> PipelineModel:
    """Perceptron classifier. Its input width is read from the assembled vector."""
    prepared = Pipeline(stages=spec.stages()).fit(train)
    features = prepared.transform(train)
    layers = [vector_width(features, "assembled_features"), *hidden, classes]
    model = MultilayerPerceptronClassifier(
        featuresCol=spec.output, labelCol=target, layers=layers, **params
    ).fit(features)
    return PipelineModel(stages=[*prepared.stages, model])


def slot_values(scored: DataFrame, values) -> DataFrame:
    """``(slot, feature, value)`` with the names of the assembled vector."""
    names = vector_names(scored, "assembled_features")
    rows = [(i, n, float(v)) for i, (n, v) in enumerate(zip(names, values, strict=True))]
    return scored.sparkSession.createDataFrame(rows, "slot int, feature string, value double")


def coefficients(model: PipelineModel, scored: DataFrame) -> DataFrame:
    return slot_values(scored, model.stages[-1].coefficients.toArray())


def importances(model: PipelineModel, scored: DataFrame) -> DataFrame:
    return slot_values(scored, model.stages[-1].featureImportances.toArray())


def selected_features(model: PipelineModel, scored: DataFrame, epsilon: float = 1e-6) -> DataFrame:
    """Slots that an L1 fit keeps."""
    listed = coefficients(model, scored)
    return listed.filter((listed["value"] > epsilon) | (listed["value"] < -epsilon))


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def reload(model: PipelineModel, df: DataFrame) -> PipelineModel:
    """Save to the shared folder and load again (what a scoring job does)."""
    return load_model(save_model(model, scratch_path(df.sparkSession, "model")))
