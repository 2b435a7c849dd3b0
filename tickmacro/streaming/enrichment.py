"""The updating join of bars with the latest macro value, as a stream.

A bar comes out when it arrives and again whenever its series changes. Both
inputs travel in one stream, so a batch sees them at one point in time. Batch N
does, from what batches before N left behind:

1. bars:  the bars that arrived;
2. state: the last release of the series, or the state of batch N-1 if none arrived;
3. out:   the new bars, and after a change the earlier ones too, with the state as of N.

Each is written as changelog partition N, bars and out in a folder per day. Running batch N again reads the
partitions before N and writes partition N once more, so it adds nothing. A
batch without a change costs what arrived in it, however long the history is.
"""

from __future__ import annotations

from datetime import date

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from tickmacro.operators.enrich import DEFAULT_SERIES, ENRICHED_KEY, enrich
from tickmacro.operators.state import latest_by_key, latest_state
from tickmacro.operators.retention import live
from tickmacro.schemas import ENRICHED, MACRO_STATE
from tickmacro.sources.tables import DAY
from tickmacro.streaming.jobs import (
    BATCH,
    compact_changelog,
    read_batch,
    read_changelog,
    start_foreach,
    write_batch,
)

_BAR_FIELDS = ["symbol", "window_start", "close_price", "volume", "tick_count"]
_DATED = StructField(DAY, DateType())
_BARS = StructType([*[ENRICHED[name] for name in _BAR_FIELDS], _DATED])
_STATE = StructType([*MACRO_STATE.fields, StructField("changed_in", LongType())])
_OUT = StructType([*ENRICHED.fields, StructField("bar_batch", LongType()), _DATED])


def tag_inputs(bars: DataFrame, releases: DataFrame, arrival: Column) -> DataFrame:
    """Bars and decoded releases as one stream of (bar, release, arrival)."""
    bar = F.struct(*_BAR_FIELDS)
    release = F.struct("payload.series_id", "payload.value", "payload.release_ts_ms")
    left = bars.select(bar.alias("bar"))
    right = releases.select(release.alias("payload"), arrival.alias("arrival"))
    return left.unionByName(right, allowMissingColumns=True)


def start_enrichment(
    bars: DataFrame,
    releases: DataFrame,
    root: str,
    checkpoint: str,
    *,
    arrival: Column,
    series_id: str = DEFAULT_SERIES,
    reemit: bool = True,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the join; its changelogs are ``root``/out, /state and /bars.

    With ``reemit=False`` a bar comes out once, with the value known at that
    time, and bars that came before the first value do not come out.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _enrich_batch(spark, batch, batch_id, root, series_id, reemit)
        finally:
            batch.unpersist()

    return start_foreach(tag_inputs(bars, releases, arrival), step, checkpoint, trigger=trigger)


def _enrich_batch(
    spark: SparkSession,
    batch: DataFrame,
    batch_id: int,
    root: str,
    series_id: str,
    reemit: bool,
) -> None:
    bars_path, state_path = f"{root}/bars", f"{root}/state"
    arrived = batch.where(F.col("bar").isNotNull()).select("bar.*", F.to_date("bar.window_start").alias(DAY))
    write_batch(arrived, bars_path, batch_id, [DAY])

    releases = batch.where(F.col("payload").isNotNull())
    state = latest_state(releases, arrival="arrival").where(F.col("series_id") == series_id)
    state = state.withColumn("changed_in", F.lit(batch_id).cast("bigint"))
    if batch_id > 0:
        state = state.unionByName(read_batch(spark, state_path, _STATE, batch_id - 1))
        state = latest_by_key(state, ["series_id"], "changed_in", _STATE.fieldNames()[1:])
    write_batch(state, state_path, batch_id)

    # From here on everything is read from what was written.
    state = read_batch(spark, state_path, _STATE, batch_id)
    if reemit and not state.where(F.col("changed_in") == batch_id).isEmpty():
        bars = live(spark, read_changelog(spark, bars_path, _BARS), bars_path).where(F.col(BATCH) <= batch_id)
        bars = bars.withColumnRenamed(BATCH, "bar_batch")
    else:
        bars = read_batch(spark, bars_path, _BARS, batch_id)
        bars = bars.withColumn("bar_batch", F.lit(batch_id).cast("bigint"))
    out = enrich(bars, state, series_id, keep=("bar_batch", DAY))
    write_batch(out, f"{root}/out", batch_id, [DAY])


def _version() -> Column:
    """The newest batch wins; within it, the bar that arrived last."""
    return F.shiftleft(BATCH, 31) + F.col("bar_batch")


def read_enriched(
    spark: SparkSession, root: str, *, since: Column | date | None = None, until: Column | date | None = None
) -> DataFrame:
    """The upserted table: the last version of each (symbol, minute, series).

    ``since`` and ``until`` are days, both included; other folders are not read.
    """
    rows = live(spark, read_changelog(spark, f"{root}/out", _OUT), f"{root}/out")
    if since is not None:
        rows = rows.where(F.col(DAY) >= (since if isinstance(since, Column) else F.lit(since)))
    if until is not None:
        rows = rows.where(F.col(DAY) <= (until if isinstance(until, Column) else F.lit(until)))
    columns = [c for c in ENRICHED.fieldNames() if c not in ENRICHED_KEY]
    return latest_by_key(rows, ENRICHED_KEY, _version(), columns)


def emissions(spark: SparkSession, root: str) -> DataFrame:
    """(key, versions): how often each bar is in ``out``, superseded versions included."""
    return read_changelog(spark, f"{root}/out", _OUT).groupBy(*ENRICHED_KEY).agg(F.count("*").alias("versions"))


def compact_enriched(spark: SparkSession, root: str) -> int | None:
    """Fold the superseded versions in ``out`` while the stream goes on; run it now and
    then where bars are emitted again. Returns what ``compact_changelog`` does."""
    return compact_changelog(spark, f"{root}/out", _OUT, ENRICHED_KEY, _version(), [DAY])


def view_enriched(
    spark: SparkSession, root: str, series_id: str = DEFAULT_SERIES
) -> DataFrame:
    """The same table, joined when it is read.

    It needs no re-emission: over a long history run the job with
    ``reemit=False`` and read this, instead of writing every bar again for
    each release.
    """
    bars = live(spark, read_changelog(spark, f"{root}/bars", _BARS), f"{root}/bars")
    bars = latest_by_key(bars, ["symbol", "window_start"], BATCH)
    state = read_changelog(spark, f"{root}/state", _STATE)
    state = latest_by_key(state, ["series_id"], "changed_in", MACRO_STATE.fieldNames()[1:])
    return enrich(bars, state, series_id)
