"""Bars joined with the latest value of one macro series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmacro.functions.times import age_minutes

DEFAULT_SERIES = "DFF"
ENRICHED_KEY = ["symbol", "window_start", "series_id"]


def enrich(
    bars: DataFrame,
    state: DataFrame,
    series_id: str = DEFAULT_SERIES,
    *,
    proc_time: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Inner join on the series; no bar comes out before the series has a value.

    ``state`` is keyed by series, so the wanted value is one row. It is looked
    up once as a scalar: bars are not shuffled for it, and a second row for the
    series is an error rather than a copy of every bar. ``keep`` names further
    bar columns to carry along.
    """
    value = F.struct("series_id", "macro_value", "release_ts_ms")
    current = state.where(F.col("series_id") == series_id).select(value).scalar()
    joined = (
        bars.withColumn("state", current)
        .where(F.col("state").isNotNull())
        .select(*[c for c in bars.columns if c != "series_id"], "state.*")
    )
    columns = [
        "symbol",
        "window_start",
        "close_price",
        "volume",
        "tick_count",
        "series_id",
        "macro_value",
        "release_ts_ms",
        age_minutes("window_start", "release_ts_ms").alias("macro_age_minutes"),
        *keep,
    ]
    if proc_time:
        columns.append(F.current_timestamp().alias("proc_time"))
    return joined.select(*columns)
