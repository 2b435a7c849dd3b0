"""Daily closes, their as-of macro value, and the rolling correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickmacro.functions.stats import corr_over
from tickmacro.operators.enrich import DEFAULT_SERIES
from tickmacro.session import new_dir

FRAME = 30


def market_daily(bars: DataFrame) -> DataFrame:
    """Last close, volume and ticks of each symbol and day of silver bars."""
    return bars.groupBy("dt", "symbol").agg(
        F.max_by("close_price", "bucket_1m_utc").alias("close_price"),
        F.sum("volume").alias("volume"),
        F.sum("tick_count").alias("tick_count"),
    )


# An instant within its day and an observation date, in one number: 2 ** 18 days
# around 1970 are told apart, dates beyond count as the first or last of them.
_DATES = 1 << 18


def release_days(releases: DataFrame, series_id: str = DEFAULT_SERIES) -> DataFrame:
    """(series_id, from_dt, macro_value, macro_release_ts_utc): the last release of each day.

    Among releases at the same instant the newest observation wins, then the greater
    value. Instant and observation date are packed into one number, so both steps
    are hash aggregates over columns of fixed width and nothing is sorted. The number
    tells observation dates from 1611 to 2328 apart; those before, and those after, tie
    and leave the decision to the value.
    """
    day = F.to_date("release_ts_utc")
    date = F.coalesce(F.unix_date("observation_date") + _DATES // 2, F.lit(0))
    date = F.greatest(F.lit(0), F.least(F.lit(_DATES - 1), date))
    micros = F.unix_micros("release_ts_utc") - F.unix_micros(day.cast("timestamp"))
    known = releases.where((F.col("series_id") == series_id) & F.col("release_ts_utc").isNotNull())
    packed = known.select("series_id", day.alias("from_dt"), (micros * _DATES + date).alias("at"), "macro_value")
    instants = packed.groupBy("series_id", "from_dt", "at").agg(F.max("macro_value").alias("macro_value"))
    days = instants.groupBy("series_id", "from_dt").agg(
        F.max_by("macro_value", "at").alias("macro_value"), F.max("at").alias("at")
    )
    instant = F.unix_micros(F.col("from_dt").cast("timestamp")) + F.floor(F.col("at") / _DATES)
    return days.select("series_id", "from_dt", "macro_value", F.timestamp_micros(instant).alias("macro_release_ts_utc"))


def asof_calendar(days: DataFrame) -> DataFrame:
    """The value of one series in force at the end of each day, from ``release_days``.

    One row per calendar day, from the first release to the last. The window sees
    at most one row per calendar day whatever the size of the series.
    """
    following = F.lead("from_dt").over(Window.partitionBy("series_id").orderBy("from_dt"))
    until = F.coalesce(F.date_sub(following, 1), "from_dt")
    return days.withColumn("until", until).select(
        F.explode(F.sequence("from_dt", "until")).alias("asof_dt"), "macro_value", "macro_release_ts_utc"
    )


def align_daily(
    daily: DataFrame, releases: DataFrame, series_id: str = DEFAULT_SERIES
) -> DataFrame:
    """Each day with the newest release known before its midnight.

    A release counts for the day it falls on. Days before the first release
    keep NULLs; days after the last one use the last.

    The inequality becomes an equality on the day: the calendar holds every day
    between releases, and later days look up the last. The releases are read once:
    their days, one row for each, are written to the shared folder, and calendar
    and last day come from there. Spark broadcasts the calendar when its size
    allows and otherwise sorts and merges.
    """
    spark = releases.sparkSession
    path = new_dir(spark, "release-days")
    days = release_days(releases, series_id)
    days.write.parquet(path)
    days = spark.read.schema(days.schema).parquet(path)
    last_day = days.agg(F.max("from_dt")).scalar()
    return (
        daily.withColumn("asof_dt", F.least("dt", last_day))
        .join(asof_calendar(days), "asof_dt", "left")
        .select(
            "symbol",
            "close_price",
            "volume",
            "tick_count",
            "macro_value",
            "macro_release_ts_utc",
            "dt",
        )
    )


def rolling_corr(
    df: DataFrame,
    x: str,
    y: str,
    *,
    by: str,
    order: str | Column,
    rows: int = FRAME,
    days: int | None = None,
    name: str = "rolling_corr",
) -> DataFrame:
    """Correlation of ``x`` and ``y`` over the last ``rows`` rows of each ``by``.

    With ``days`` the frame is that many calendar days instead. ``by`` and
    ``order`` together should name one row; at a daily grain a group then has
    at most one row per calendar day.
    """
    order = F.col(order) if isinstance(order, str) else order
    if days is None:
        frame = Window.partitionBy(by).orderBy(order).rowsBetween(1 - rows, Window.currentRow)
    else:
        frame = (
            Window.partitionBy(by)
            .orderBy(F.unix_date(order))
            .rangeBetween(1 - days, Window.currentRow)
        )
    return df.withColumn(name, corr_over(F.col(x), F.col(y), frame))


def correlation_daily(aligned: DataFrame, rows: int = FRAME) -> DataFrame:
    """``rolling_corr_30d`` per symbol and day; the frame counts rows, not days."""
    return rolling_corr(
        aligned,
        "close_price",
        "macro_value",
        by="symbol",
        order="dt",
        rows=rows,
        name="rolling_corr_30d",
    ).select("symbol", "rolling_corr_30d", "dt")
