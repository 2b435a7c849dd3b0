"""Bars and releases in their stored form, dated for partition pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmacro.functions.times import instant, text_date
from tickmacro.schemas import RELEASE_EVENT

_PAYLOAD = RELEASE_EVENT["payload"].dataType.fieldNames()


def silver_bars(bars: DataFrame) -> DataFrame:
    return bars.select(
        F.to_date("window_start").alias("dt"),
        F.col("window_start").alias("bucket_1m_utc"),
        "symbol",
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
        "tick_count",
    )


def silver_releases(releases: DataFrame) -> DataFrame:
    """Every copy of a release is kept; ``dt`` is its release day."""
    flat = releases.select(*[f"payload.{name}" for name in _PAYLOAD])
    return flat.withColumn("release_ts_utc", instant("release_ts_ms")).select(
        F.to_date("release_ts_utc").alias("dt"),
        "series_id",
        text_date("observation_date").alias("observation_date"),
        F.col("value").alias("macro_value"),
        "release_ts_utc",
        text_date("realtime_start").alias("realtime_start"),
        text_date("realtime_end").alias("realtime_end"),
    )
