"""Feature stages: index, encode, assemble, scale. Rows with unknown values are skipped."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.base import Estimator, Transformer
from pyspark.ml.feature import (
    MinMaxScaler,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: A partition with more than this times the rows it should have is too large.
UNEVEN = 4

#: Rows of a partition where every step of a fit is a pass over few columns: a frame that has
#: TASKS_PER_CORE partitions of the first size for every core gets larger ones, up to the second.
STEP_ROWS = 50_000
MOST_STEP_ROWS = 200_000
TASKS_PER_CORE = 4


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns are categories, which are numbers, and how they become one vector."""

    categorical: Sequence[str] = field(default_factory=tuple)
    numeric: Sequence[str] = field(default_factory=tuple)
    one_hot: bool = True
    scaler: str = "minmax"  # or "standard"
    output: str = "features"

    def stages(self) -> list[Estimator | Transformer]:
        stages: list[Estimator | Transformer] = []
        indexed = [f"{c}_indexed" for c in self.categorical]
        inputs = indexed
        if indexed:
            stages.append(
                StringIndexer(
                    inputCols=list(self.categorical),
                    outputCols=indexed,
                    handleInvalid="skip",
                    stringOrderType="frequencyDesc",
                )
            )
        if indexed and self.one_hot:
            inputs = [f"{c}_encoded" for c in self.categorical]
            stages.append(OneHotEncoder(inputCols=indexed, outputCols=inputs))
        stages.append(
            VectorAssembler(
                inputCols=[*inputs, *self.numeric],
                outputCol="assembled_features",
                handleInvalid="skip",
            )
        )
        stages.append(self._scaling())
        return stages

    def _scaling(self) -> Estimator:
        if self.scaler == "standard":
            return StandardScaler(
                inputCol="assembled_features", outputCol=self.output, withMean=True, withStd=True
            )
        return MinMaxScaler(inputCol="assembled_features", outputCol=self.output)


def numeric_as_double(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Widen the numeric features in one projection and leave the rest as it is."""
    wanted = set(numeric)
    return df.select(
        *[F.col(c).cast("double").alias(c) if c in wanted else F.col(c) for c in df.columns]
    )


def vector_names(df: DataFrame, column: str) -> list[str]:
    """Name of each vector slot from the column metadata (one-hot widens the vector)."""
    groups = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    slots = [attr for attrs in groups.values() for attr in attrs]
    return [a.get("name", str(a["idx"])) for a in sorted(slots, key=lambda a: a["idx"])]


def vector_width(df: DataFrame, column: str) -> int:
    """Slots of a vector column, from its metadata."""
    return int(df.schema[column].metadata["ml_attr"]["num_attrs"])


def cache_for_training(df: DataFrame, rows_per_partition: int = 25_000) -> DataFrame:
    """Keep a training frame, in as many even partitions as its rows need.

    Iterative fits run one job per step, so a fold of a few thousand rows must not be spread over
    hundreds of tiny partitions, and one partition that holds most of the rows would be read by a
    single task in every step. Large frames keep partitions that are about even.
    """
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    sizes = [row["count"] for row in held.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    wanted = max(1, math.ceil(sum(sizes) / rows_per_partition))
    if wanted >= held.rdd.getNumPartitions() and max(sizes, default=0) <= UNEVEN * rows_per_partition:
        return held
    sized = held.repartition(wanted).persist(StorageLevel.MEMORY_AND_DISK)
    sized.count()
    held.unpersist()
    return sized


def step_partitions(rows: int, cores: int) -> int:
    """Partitions of a frame that is read once in every step of a fit. A task costs about as much
    to start as ten thousand rows of a step, so beyond a few for each core they are made longer."""
    return max(1, math.ceil(rows / MOST_STEP_ROWS), min(math.ceil(rows / STEP_ROWS), TASKS_PER_CORE * cores))


def cache_for_steps(df: DataFrame) -> DataFrame:
    """Keep a narrow training frame that fits read hundreds of times, dealt out evenly.

    Its rows are counted first and kept once, so ``df`` should come from a kept frame.
    """
    wanted = step_partitions(df.count(), df.sparkSession.sparkContext.defaultParallelism)
    kept = df.repartition(wanted).persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    return kept
