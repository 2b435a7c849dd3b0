"""Bars as served to dashboards: minute time, one dimension, three metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmacro.functions.times import as_of_column
from tickmacro.schemas import SERVING_BAR
from tickmacro.streaming.merging import read_folders

LATE_AFTER = "2 hours"
METRICS = ["close_price_sum", "volume_proxy_sum", "tick_count_sum"]


def reject_late(
    bars: DataFrame,
    late_after: str = LATE_AFTER,
    as_of: Column | datetime | str | None = None,
) -> DataFrame:
    """Drop bars that start more than ``late_after`` before the hour of ``as_of``.

    The bound moves once an hour. On a stream the default ``as_of`` is the time of
    each micro-batch.
    """
    bound = F.date_trunc("hour", as_of_column(as_of)) - F.expr(f"INTERVAL {late_after}")
    return bars.where(F.col("window_start") >= bound)


def serving_bars(bars: DataFrame, *, rollup: bool = False) -> DataFrame:
    """Serving rows, one per bar; with ``rollup``, one per minute and symbol."""
    rows = bars.select(
        F.date_trunc("minute", "window_start").alias("time"),
        "symbol",
        F.col("close_price").cast("double").alias("close_price_sum"),
        F.col("volume").cast("bigint").alias("volume_proxy_sum"),
        F.col("tick_count").cast("bigint").alias("tick_count_sum"),
    )
    if not rollup:
        return rows
    return rows.groupBy("time", "symbol").agg(*[F.sum(m).alias(m) for m in METRICS])


def with_segment(rows: DataFrame) -> DataFrame:
    """Add ``hour``, the partition a serving row is stored in."""
    return rows.withColumn("hour", F.date_format(F.date_trunc("hour", "time"), "yyyy-MM-dd-HH"))


def read_serving(spark: SparkSession, path: str) -> DataFrame:
    """Stored serving rows; a filter on ``hour`` prunes folders, as long as they are not
    merged; ``merging.read_folders`` reads the merged files of given hours alone."""
    return read_folders(spark, path, SERVING_BAR, "hour")
