"""Latest value per key: the read side of an upsert table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(
    changelog: DataFrame, keys: list[str], version: str | Column, columns: list[str] | None = None
) -> DataFrame:
    """The row with the greatest ``version`` of each key.

    Every column asks for the same greatest version in the same pass, so all of
    them come from one row. A number or timestamp as version keeps this a hash
    aggregate; a struct also works, by sorting.
    """
    if columns is None:
        columns = [c for c in changelog.columns if c not in keys]
    order = F.col(version) if isinstance(version, str) else version
    return changelog.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in columns])


def macro_changes(releases: DataFrame) -> DataFrame:
    """Decoded releases as state rows; other columns stay beside them."""
    others = [c for c in releases.columns if c != "payload"]
    return releases.select(
        F.col("payload.series_id").alias("series_id"),
        F.col("payload.value").alias("macro_value"),
        F.col("payload.release_ts_ms").alias("release_ts_ms"),
        *others,
    )


def latest_state(
    releases: DataFrame, *, by: str = "arrival", arrival: str | Column = "offset"
) -> DataFrame:
    """(series_id, macro_value, release_ts_ms) per series.

    ``arrival`` keeps the row that came last, whatever its release time.
    ``release_ts`` keeps the newest release, the later arrival on a tie.
    """
    changes = macro_changes(releases)
    order = F.col(arrival) if isinstance(arrival, str) else arrival
    if by == "release_ts":
        order = F.struct("release_ts_ms", order)
    elif by != "arrival":
        raise ValueError(f"by must be 'arrival' or 'release_ts', got {by!r}")
    return latest_by_key(changes, ["series_id"], order, ["macro_value", "release_ts_ms"])
