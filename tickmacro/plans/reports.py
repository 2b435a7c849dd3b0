"""Report queries over bars and correlations."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickmacro.functions.times import as_of_column

RECENT_BAR_COLUMNS = [
    "bucket_1m_utc",
    "symbol",
    "open_price",
    "close_price",
    "volume",
    "tick_count",
]


def correlation_latest(correlation: DataFrame, symbol: str = "GOOG", days: int = 50) -> DataFrame:
    """The newest days of one symbol."""
    return correlation.where(F.col("symbol") == symbol).orderBy(F.col("dt").desc()).limit(days)


def avg_corr_by_symbol(correlation: DataFrame) -> DataFrame:
    """Symbols ranked by average correlation; undefined ones come last."""
    return (
        correlation.groupBy("symbol")
        .agg(F.avg("rolling_corr_30d").alias("avg_corr_30d"))
        .orderBy(F.col("avg_corr_30d").desc_nulls_last(), "symbol")
    )


def recent_bars(bars: DataFrame, rows: int = 50, *, by_day: bool = False) -> DataFrame:
    """The newest silver bars of all symbols.

    ``by_day`` is for a table partitioned by ``dt``: rows are first counted per
    day, which reads file footers only, and then just the newest days that hold
    ``rows`` bars are scanned.
    """
    if by_day:
        bars = bars.where(F.col("dt") >= _first_day_of_newest(bars, rows))
    return (
        bars.select(*RECENT_BAR_COLUMNS)
        .orderBy(F.col("bucket_1m_utc").desc(), "symbol")
        .limit(rows)
    )


def _first_day_of_newest(bars: DataFrame, rows: int) -> Column:
    """The latest day such that it and the days after it hold ``rows`` bars."""
    # One row per stored day, so the unpartitioned window is small.
    newer = Window.orderBy(F.col("dt").desc()).rowsBetween(Window.unboundedPreceding, -1)
    days = bars.groupBy("dt").agg(F.count(F.lit(1)).alias("bars"))
    needed = days.withColumn("newer", F.coalesce(F.sum("bars").over(newer), F.lit(0))).where(
        F.col("newer") < rows
    )
    return needed.agg(F.min("dt")).scalar()


def close_timeseries(
    bars: DataFrame,
    hours: int = 1,
    as_of: Column | datetime | str | None = None,
    rows: int = 1000,
) -> DataFrame:
    """Average close per minute and symbol from ``hours`` before ``as_of`` up to it.

    ``dt`` is bounded on both ends as well, so a partitioned bar table is read for
    the days of that range only.
    """
    until = as_of_column(as_of)
    since = until - F.make_dt_interval(hours=F.lit(hours))
    return (
        bars.where(F.col("dt").between(F.to_date(since), F.to_date(until)))
        .where(F.col("bucket_1m_utc").between(since, until))
        .groupBy("bucket_1m_utc", "symbol")
        .agg(F.avg("close_price").alias("avg_close_price"))
        .orderBy(F.col("avg_close_price").desc_nulls_last(), "bucket_1m_utc", "symbol")
        .limit(rows)
    )


def event_sample(events: DataFrame, rows: int = 3) -> DataFrame:
    """The first events by event time."""
    return events.orderBy("event_ts_ms", "event_id").limit(rows)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), one row per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
