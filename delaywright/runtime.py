"""Session helpers: the shared scratch folder, durable intermediate tables, lineage cuts."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("delaywright")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("DELAYWRIGHT_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, or the checkpoint folder the
    context has been given. Without either there is no safe place for intermediate tables, so
    that is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir", None
    )
    current = context.getCheckpointDir()
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured
    if current:
        return current
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/delaywright/{tag}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there (small iterated frames)."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def spool(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and return a scan of it.

    Unlike a checkpoint the copy is compressed, columnar and prunable; use it when a later
    stage must see exactly the same rows in exactly the same slices, even after a lost executor.
    ``release`` removes the copy when nothing will read it any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.mode("errorifexists").parquet(path)
    copy = spark.read.schema(df.schema).parquet(path)
    copy.spooled_at = path
    return copy


def release(*copies: DataFrame) -> None:
    """Remove the tables that ``spool`` wrote; frames derived from them can no longer be read."""
    for copy in copies:
        jvm = copy.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(copy.spooled_at)
        path.getFileSystem(copy.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
