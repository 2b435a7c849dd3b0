"""Landed responses of the quote and observation services, parsed as jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickmacro.functions.times import midnight_ms

MISSING = "."
_CORRUPT, _BODY = "_corrupt_record", "_parsed_body"
_QUOTE = f"c string, t string, {_CORRUPT} string"
_OBSERVATIONS = (
    "observations array<struct<date: string, value: string, "
    f"realtime_start: string, realtime_end: string>>, {_CORRUPT} string"
)


def parse_series(csv: str) -> list[str]:
    """``"DFF, UNRATE,"`` to ``["DFF", "UNRATE"]``."""
    return [part.strip() for part in csv.split(",") if part.strip()]


def _parsed(responses: DataFrame, schema: str, broken: Callable[[Column], Column]) -> DataFrame:
    """``responses`` with the body parsed once, in a column of its own, and ``dead``.

    All that is asked of the body afterwards refers to that column; what
    ``split_quotes`` and ``split_observations`` have parsed is not parsed again.
    """
    if _BODY in responses.columns:
        return responses
    body = F.from_json("body", schema, {"columnNameOfCorruptRecord": _CORRUPT})
    found = responses.withColumn(_BODY, body)
    b = F.col(_BODY)
    return found.withColumn("dead", b.isNull() | b[_CORRUPT].isNotNull() | broken(b))


def split_quotes(responses: DataFrame) -> DataFrame:
    """``responses`` with ``dead``: true where the body can't be read as a quote, as it is
    no JSON or lacks a price or time. What was parsed stays beside it for ``quotes``."""
    return _parsed(
        responses, _QUOTE, lambda q: q["c"].try_cast("double").isNull() | q["t"].try_cast("bigint").isNull()
    )


def split_observations(responses: DataFrame) -> DataFrame:
    """``responses`` with ``dead``: true where the body is no JSON or lists an observation
    without a date. A response without a list is whole and lists nothing. What was parsed
    stays beside it for ``raw_observations``."""
    listed = lambda o: F.coalesce(o["observations"], F.array())
    return _parsed(responses, _OBSERVATIONS, lambda o: F.exists(listed(o), lambda x: x["date"].isNull()))


def _or_fail(value: Column, kind: str) -> Column:
    fault = F.raise_error(F.lit("broken response body; split it off first")).cast(kind)
    return F.when(F.col("dead"), fault).otherwise(value)


def quotes(responses: DataFrame) -> DataFrame:
    """(symbol, body) rows to (symbol, price, event_ts_ms, size).

    A polled quote has no size, so each counts as 1. A broken body fails the job
    unless ``split_quotes`` has set it aside.
    """
    q = F.col(_BODY)
    return split_quotes(responses).select(
        "symbol",
        _or_fail(q["c"].try_cast("double"), "double").alias("price"),
        (q["t"].try_cast("bigint") * F.lit(1000)).alias("event_ts_ms"),
        F.lit(1).cast("bigint").alias("size"),
    )


def raw_observations(responses: DataFrame, series: list[str] | None = None) -> DataFrame:
    """(series_id, body) rows to one row per listed observation, still text.

    A broken body fails the job unless ``split_observations`` has set it aside.
    """
    if series is not None:
        responses = responses.where(F.col("series_id").isin(series))
    kind = "array<struct<date: string, value: string, realtime_start: string, realtime_end: string>>"
    listed = _or_fail(F.col(_BODY)["observations"], kind)
    return split_observations(responses).select("series_id", F.explode(listed).alias("o")).select("series_id", "o.*")


def newest_observations(observations: DataFrame, limit: int, *, salts: int = 64) -> DataFrame:
    """The ``limit`` newest observations of each series.

    Every task first cuts a series to its ``limit`` newest rows. Those meet in
    ``salts`` parts per series, are cut again, and only then in one task, which
    sees ``salts * limit`` rows of a series at most. The cut before the shuffle
    holds for limits up to the session's ``windowGroupLimitThreshold``, which
    ``build_session`` raises; the rows are the same beyond it.
    """
    newest = [
        F.col(c).desc_nulls_last() for c in ("date", "realtime_start", "realtime_end", "value")
    ]

    def top(df: DataFrame, *keys: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
        return df.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")

    # By task, not by content: copies of one observation spread as well.
    salt = F.pmod(F.spark_partition_id(), F.lit(salts))
    salted = top(observations.withColumn("_salt", salt), "series_id", "_salt")
    return top(salted.drop("_salt"), "series_id")


def observations(raw: DataFrame) -> DataFrame:
    """Typed observations. Rows marked missing are dropped before the cast.

    The release day is ``realtime_start``, or ``date`` where that is absent or
    empty; ``realtime_start/end`` default to ``date`` only where absent.
    """
    released = F.coalesce(F.nullif("realtime_start", F.lit("")), "date")
    return raw.where(F.coalesce("value", F.lit(MISSING)) != MISSING).select(
        "series_id",
        F.col("date").alias("observation_date"),
        F.col("value").cast("double").alias("value"),
        midnight_ms(released).alias("release_ts_ms"),
        F.coalesce("realtime_start", "date").alias("realtime_start"),
        F.coalesce("realtime_end", "date").alias("realtime_end"),
    )
