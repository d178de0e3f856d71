"""Parquet, CSV and local-row sources and sinks with explicit schemas."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None) -> DataFrame:
    """Parquet scan; the schema comes from the footers unless one is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_parquet_glob(spark: SparkSession, pattern: str, schema: StructType | str | None = None) -> DataFrame:
    """All Parquet datasets whose folder matches ``pattern`` (for example ``weather_data/*``)."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(pattern)


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header. Every column is a string; narrow it afterwards with ``cast_columns``.

    With ``columns`` the header is not read for the schema, so no file is opened on the driver.
    """
    reader = spark.read.option("header", "true")
    if columns is not None:
        ddl = ", ".join(f"`{c}` string" for c in columns)
        reader = reader.schema(ddl).option("enforceSchema", "false")
    return reader.csv(path)


def local_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """A small frame from local rows with a declared schema (also the empty frame)."""
    return spark.createDataFrame(list(rows), schema)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """Parquet sink. With ``partition_by``, rows are laid out so that later date filters prune."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", "true").csv(path)
    return path


def load_report(df: DataFrame, date_column: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Row count and formatted latest date, the check made after a dataset was written."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.date_format(F.max(date_column), pattern).alias("max_date"),
    )


def size_estimate(df: DataFrame, date: str, months_wanted: int) -> DataFrame:
    """Size of the rows as delimited text in bytes and GiB, and its projection from the calendar
    months that occur in ``date`` to ``months_wanted`` months (null without any month)."""
    widths = [F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) + 1 for c in df.columns]
    row_width = widths[0]
    for width in widths[1:]:
        row_width = row_width + width
    # Totals by month first: the months are counted on one row each.
    monthly = df.groupBy(F.date_format(date, "yyyy-MM").alias("month")).agg(F.sum(row_width.cast("bigint")).alias("b"))
    total = F.coalesce(F.sum("b"), F.lit(0))
    gib = total / F.lit(float(1024**3))
    return monthly.agg(
        total.alias("text_bytes"),
        gib.alias("size_gib"),
        (gib * F.try_divide(F.lit(float(months_wanted)), F.count("month"))).alias("projected_gib"),
    )


def schema_rows(df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """One row per column: position, name, type; optionally only the columns in ``keep``."""
    spark = df.sparkSession
    listed = [
        (i, f.name, f.dataType.simpleString(), f.nullable)
        for i, f in enumerate(df.schema.fields)
        if keep is None or f.name in keep
    ]
    return spark.createDataFrame(listed, "position int, name string, type string, nullable boolean")
