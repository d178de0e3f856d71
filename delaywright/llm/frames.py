"""Small shared helpers: picking input columns, walking Arrow batches, dropping finished shuffles."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows handed to one numpy or tokenizer call; texts of more characters are handled alone.
ROWS_PER_SLICE = 256
CHARS_PER_SLICE = 1_000_000


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of ``docs``, null texts as empty; other columns are left out."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """The rows of Arrow batches, a slice of them in Python at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_PER_SLICE):
            part = batch.slice(at, ROWS_PER_SLICE)
            yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)


def slices(
    batches: Iterator[pa.RecordBatch], id_column: str = "doc_id", text_column: str = "text"
) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, UTF-8 texts) of neighbouring rows, about ``CHARS_PER_SLICE`` bytes at a time."""
    ids: list = []
    data: list[bytes] = []
    size = 0
    for key, text in rows(batches, id_column, text_column):
        raw = text.encode("utf-8", "surrogatepass")
        if ids and size + len(raw) > CHARS_PER_SLICE:
            yield ids, data
            ids, data, size = [], [], 0
        ids.append(key)
        data.append(raw)
        size += len(raw)
    if ids:
        yield ids, data


def drop_finished_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files of jobs whose frames are gone.

    Called between the phases of a job, after a phase's result has been written to the shared
    folder, so that the disks hold the files of one phase and not of all.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unused(name: str, *frames: DataFrame) -> str:
    """``name`` with as many underscores before it as no column of ``frames`` has."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
