"""Fitted pipelines as column expressions: scoring without a model object, inside codegen.

A pipeline of indexing, encoding, assembling, scaling and one predictor becomes one expression
over the raw columns. Rows that the pipeline would skip (unknown category, null, NaN) are told by
a condition.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.base import Transformer
from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.ml.feature import (
    MinMaxScalerModel,
    OneHotEncoderModel,
    StandardScalerModel,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Slot:
    """A number, step by step as the stages compute it (``value``), and as ``x * factor + offset``,
    where x is ``base`` itself or, with ``category``, 1 in the rows whose ``base`` is that number and
    0 in the others."""

    value: Column
    base: Column
    category: int | None = None
    factor: float = 1.0
    offset: float = 0.0

    @classmethod
    def plain(cls, column: Column) -> Slot:
        return cls(column, column)

    def scaled(self, value: Column, factor: float, offset: float) -> Slot:
        return Slot(value, self.base, self.category, self.factor * factor, self.offset * factor + offset)


@dataclass
class CompiledModel:
    """``slots`` are the parts of every vector column made so far, ``staged`` the category indexes
    that are computed once a row, ``known`` what a row must meet to be scored."""

    staged: dict[str, Column] = field(default_factory=dict)
    slots: dict[str, list[Slot]] = field(default_factory=dict)
    known: list[Column] = field(default_factory=list)
    prediction: Column | None = None

    def score(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """``df`` without the rows that the pipeline skips, and with the prediction."""
        staged = df.withColumns(self.staged) if self.staged else df
        if self.known:
            staged = staged.filter(reduce(lambda a, b: a & b, self.known))
        return staged.select(*[F.col(c) for c in df.columns], self.prediction.alias(output))

    def parts(self, column: str) -> list[Slot]:
        """A vector's slots, or the one slot of a plain column."""
        return self.slots.get(column) or [Slot.plain(F.col(column).cast("double"))]

    def values(self, column: str) -> list[Column]:
        return [slot.value for slot in self.parts(column)]


def compile_model(model: PipelineModel) -> CompiledModel:
    """The expression of a fitted pipeline; a stage of another kind is an error."""
    compiled = CompiledModel()
    for stage in model.stages:
        step = next((f for kind, f in _STAGES if isinstance(stage, kind)), None)
        if step is None:
            raise TypeError(f"no expression for {type(stage).__name__}")
        step(compiled, stage)
    return compiled


def _index(compiled: CompiledModel, stage: StringIndexerModel) -> None:
    for source, target, labels in zip(stage.getInputCols(), stage.getOutputCols(), stage.labelsArray, strict=True):
        place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(source).cast("string"))
        compiled.staged[f"_{target}"] = place.cast("int")
        compiled.known.append(F.coalesce(F.col(f"_{target}") > 0, F.lit(False)))
        compiled.slots[target] = [Slot.plain((F.col(f"_{target}") - 1).cast("double"))]


def _encode(compiled: CompiledModel, stage: OneHotEncoderModel) -> None:
    for source, target, size in zip(stage.getInputCols(), stage.getOutputCols(), stage.categorySizes, strict=True):
        (index,) = compiled.values(source)
        compiled.slots[target] = [Slot((index == i).cast("double"), index, i) for i in range(size - stage.getDropLast())]


def _assemble(compiled: CompiledModel, stage: VectorAssembler) -> None:
    for column in stage.getInputCols():
        if column not in compiled.slots:
            value = F.col(column).cast("double")
            compiled.known.append(value.isNotNull() & ~F.isnan(value))
    compiled.slots[stage.getOutputCol()] = [v for c in stage.getInputCols() for v in compiled.parts(c)]


def _min_max(compiled: CompiledModel, stage: MinMaxScalerModel) -> None:
    low, high = stage.getMin(), stage.getMax()
    scaled = []
    for slot, least, most in zip(compiled.parts(stage.getInputCol()), stage.originalMin.toArray(), stage.originalMax.toArray(), strict=True):
        if most == least:
            even = (low + high) / 2
            scaled.append(slot.scaled(F.lit(even), 0.0, even))
        else:
            rate = float((high - low) / (most - least))
            value = (slot.value - float(least)) * rate + float(low)
            scaled.append(slot.scaled(value, rate, float(low - least * rate)))
    compiled.slots[stage.getOutputCol()] = scaled


def _standard(compiled: CompiledModel, stage: StandardScalerModel) -> None:
    scaled = []
    for slot, mean, std in zip(compiled.parts(stage.getInputCol()), stage.mean.toArray(), stage.std.toArray(), strict=True):
        shift = float(mean) if stage.getWithMean() else 0.0
        rate = (float(1 / std) if std else 0.0) if stage.getWithStd() else 1.0
        scaled.append(slot.scaled((slot.value - shift) * rate, rate, -shift * rate))
    compiled.slots[stage.getOutputCol()] = scaled


def _total(terms: list[Column]) -> Column:
    """A sum as a balanced tree, so that long ones do not nest deeply."""
    while len(terms) > 1:
        terms = [sum(terms[i + 1 : i + 2], terms[i]) for i in range(0, len(terms), 2)]
    return terms[0]


def _linear(compiled: CompiledModel, stage: LinearRegressionModel) -> None:
    compiled.prediction = _weighted_sum(compiled.parts(stage.getFeaturesCol()), stage.coefficients.toArray().tolist(), float(stage.intercept))


def _weighted_sum(slots: list[Slot], weights: list[float], constant: float) -> Column:
    """The weighted sum of the slots. Those of one category are a look-up in an array of literals:
    a term for each would be more generated code than the JVM compiles."""
    terms: list[Column] = []
    looked_up: dict[str, tuple[Column, dict[int, float]]] = {}
    for slot, weight in zip(slots, weights, strict=True):
        constant += slot.offset * weight
        rate = slot.factor * weight
        if slot.category is not None:
            looked_up.setdefault(str(slot.base), (slot.base, {}))[1][slot.category] = rate
        elif rate:
            terms.append(slot.base * rate)
    for base, rates in looked_up.values():
        known = F.array(*[F.lit(rates.get(i, 0.0)) for i in range(max(rates) + 1)])
        terms.append(F.coalesce(F.get(known, base.cast("int")), F.lit(0.0)))
    return _total([*terms, F.lit(constant)])


def _boosted(compiled: CompiledModel, stage: GBTRegressionModel) -> None:
    values = compiled.values(stage.getFeaturesCol())
    trees = [_tree(tree._call_java("rootNode"), values) * float(w) for tree, w in zip(stage.trees, stage.treeWeights, strict=True)]
    compiled.prediction = _total(trees)


def _tree(node, values: list[Column]) -> Column:
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    value = values[split.featureIndex()]
    if split.getClass().getSimpleName() == "ContinuousSplit":
        left = value <= float(split.threshold())
    else:
        left = value.isin([float(c) for c in split.leftCategories()])
    return F.when(left, _tree(node.leftChild(), values)).otherwise(_tree(node.rightChild(), values))


def _perceptron(compiled: CompiledModel, stage: MultilayerPerceptronClassificationModel) -> None:
    layers, weights = stage.getLayers(), stage.weights.toArray().tolist()
    slots, at = compiled.parts(stage.getFeaturesCol()), 0
    for i, (width, size) in enumerate(zip(layers[:-1], layers[1:], strict=True)):
        inner = weights[at : at + width * size]
        bias = weights[at + width * size : at + width * size + size]
        sums = [_weighted_sum(slots, [inner[k * size + j] for k in range(width)], bias[j]) for j in range(size)]
        # One layer is one staged array, or every layer would repeat the ones before it.
        active = F.array(*sums) if i == len(layers) - 2 else F.array(*[1 / (1 + F.exp(-s)) for s in sums])
        compiled.staged[f"_layer{i}"] = active
        slots = [Slot.plain(F.col(f"_layer{i}")[j]) for j in range(size)]
        at += width * size + size
    # The class of the greatest output; of equal ones the first.
    last = F.col(f"_layer{len(layers) - 2}")
    compiled.prediction = (F.array_position(last, F.array_max(last)) - 1).cast("double")


_STAGES: list[tuple[type[Transformer], Callable]] = [
    (StringIndexerModel, _index),
    (OneHotEncoderModel, _encode),
    (VectorAssembler, _assemble),
    (MinMaxScalerModel, _min_max),
    (StandardScalerModel, _standard),
    (LinearRegressionModel, _linear),
    (GBTRegressionModel, _boosted),
    (MultilayerPerceptronClassificationModel, _perceptron),
]
