"""Parquet tables: batch scans, streams and external tables over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StructField, StructType

from tickmacro.operators.retention import live
from tickmacro.schemas import BAR, SILVER_BAR, SILVER_RELEASE
from tickmacro.streaming.merging import read_folders

#: What dated folders are named by.
DAY = "dt"


def read_bars(spark: SparkSession, path: str, **stream) -> DataFrame:
    """The bar table. ``streaming=True`` follows its writer; ``max_files`` then
    bounds how many new files one micro-batch takes."""
    return _read(spark, path, BAR, **stream)


def silver_bars(spark: SparkSession, path: str, **stream) -> DataFrame:
    return _read(spark, path, SILVER_BAR, **stream)


def silver_releases(spark: SparkSession, path: str, **stream) -> DataFrame:
    return _read(spark, path, SILVER_RELEASE, **stream)


def _read(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    streaming: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stored = schema if DAY in schema.fieldNames() else StructType([*schema.fields, StructField(DAY, DateType())])
    if streaming:
        rows = reader.schema(stored).parquet(path)
    else:
        rows = live(spark, read_folders(spark, path, stored, DAY), path)
    # A partition column comes last from the scan; the declared order is restored.
    return rows.select(*schema.fieldNames())


def create_external_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    path: str,
    *,
    partition_by: str | None = "dt",
) -> None:
    """A catalog table over files that another job writes."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {partitioned} "
        f"LOCATION '{path}'"
    )
    if partition_by:
        refresh_partitions(spark, name)


def refresh_partitions(spark: SparkSession, name: str) -> None:
    """Register partition folders that appeared since the last refresh."""
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
