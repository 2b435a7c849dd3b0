"""Streaming jobs: the batch operators between a source and a sink."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from tickmacro.files import children, delete, exists, publish_batch, stream_id
from tickmacro.functions.envelopes import encode_rows
from tickmacro.operators import bars as bar_ops
from tickmacro.operators import serving, silver, state
from tickmacro.operators.retention import live
from tickmacro.schemas import BAR_TOPIC, MACRO_STATE, ROUTED_EVENT, TOPIC_KEYS
from tickmacro.sources.tables import DAY

COMMIT_INTERVAL = {"processingTime": "30 seconds"}
#: Over how many partitions a stream's state is spread: as many as the topic of bars has.
STATE_PARTITIONS = 24
BATCH = "batch_id"
# Spark does not read folders of such names with the batches beside them.
_BASE = "_base"


def start_append(
    df: DataFrame,
    path: str | None,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    rebalance: bool = True,
    trigger: dict | None = None,
    options: dict[str, str] | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append rows to any sink; ``console`` prints instead of sending.

    A partitioned parquet folder gets plain files (see ``files``), so that catalog
    tables, other engines and retention can use it; each batch is in it once, also
    after a restart. ``rebalance`` gathers each folder into few files per micro-batch
    and splits a large one, instead of a file per task and folder. ``state_partitions``
    is for streams that keep state, see ``state_over``.
    """
    if path and partition_by and fmt == "parquet":
        known: list[str] = []

        def write(batch: DataFrame, batch_id: int) -> None:
            known or known.append(stream_id(batch.sparkSession, checkpoint))
            rows = batch.hint("rebalance", *partition_by) if rebalance else batch
            publish_batch(rows, path, known[0], batch_id, partition_by)

        return start_foreach(df, write, checkpoint, trigger=trigger, state_partitions=state_partitions)
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**(options or {}))
        .trigger(**(trigger or COMMIT_INTERVAL))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with state_over(df.sparkSession, state_partitions):
        return writer.start(path) if path else writer.start()


@contextmanager
def state_over(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """A stream that starts here spreads its state over ``partitions``, or over the session's
    shuffle partitions where these are fewer, or with None.

    Every one of them is loaded and committed in every micro-batch, however few rows it
    holds, and adaptive execution joins none of them: the number that large batch shuffles
    want costs a stream more than its rows do. Checkpoints keep the number they began with.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if partitions is not None:
        spark.conf.set(name, str(min(partitions, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def send_events(
    events: DataFrame,
    fmt: str,
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Send a batch of (topic, key, value) rows.

    ``kafka`` routes each row to its topic and acknowledges on all replicas;
    a file format appends to a folder per topic; ``console`` prints.
    """
    writer = events.write.format(fmt).mode("append")
    if fmt == "kafka":
        writer = writer.option("kafka.acks", "all")
    elif path:
        writer = writer.partitionBy("topic")
    writer = writer.options(**(options or {}))
    writer.save(path) if path else writer.save()


def start_bars(
    ticks: DataFrame,
    path: str,
    checkpoint: str,
    *,
    interval: str = "1 minute",
    state_partitions: int | None = STATE_PARTITIONS,
    **sink,
) -> StreamingQuery:
    """Closed bars of a watermarked tick stream, in a folder per day.

    The query's progress counts the ticks in and the ticks in bars, see ``tick_account``.
    """
    counted = ticks.observe("ticks", F.count(F.lit(1)).alias("n"))
    bars = bar_ops.build_bars(counted, interval).withColumn(DAY, F.to_date("window_start"))
    bars = bars.observe("bars", F.sum("tick_count").alias("n"))
    return start_append(
        bars, path, checkpoint, partition_by=[DAY], state_partitions=state_partitions, **sink
    )


def tick_account(query: StreamingQuery) -> dict[str, int]:
    """What became of the ticks of a bar stream, from the progress it keeps.

    ``ticks`` came in, ``in_bars`` are in bars that closed, and ``bars_dropped`` counts the
    symbols and windows that came too late, once for each batch. When all windows are
    closed the ticks that are in no bar were dropped; until then some are still open.
    ``spark.sql.streaming.numRecentProgressUpdates`` bounds how many batches are kept.
    """
    out = {"ticks": 0, "in_bars": 0, "bars_dropped": 0}
    for progress in query.recentProgress:
        observed = progress["observedMetrics"]
        out["ticks"] += (observed["ticks"]["n"] or 0) if "ticks" in observed else 0
        out["in_bars"] += (observed["bars"]["n"] or 0) if "bars" in observed else 0
        out["bars_dropped"] += sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"])
    return out


def start_bar_events(
    ticks: DataFrame,
    path: str | None,
    checkpoint: str,
    *,
    interval: str = "1 minute",
    state_partitions: int | None = STATE_PARTITIONS,
    **sink,
) -> StreamingQuery:
    """Closed bars as keyed JSON events, for Kafka or, in a folder per topic, files."""
    sink["state_partitions"] = state_partitions
    events = encode_rows(bar_ops.build_bars(ticks, interval), BAR_TOPIC, TOPIC_KEYS[BAR_TOPIC])
    if path is None:
        return start_append(events, path, checkpoint, **sink)
    return start_routed(events, path, checkpoint, **sink)


def start_silver_bars(bars: DataFrame, path: str, checkpoint: str, **sink) -> StreamingQuery:
    return start_append(
        silver.silver_bars(bars), path, checkpoint, partition_by=["dt"], **sink
    )


def start_silver_releases(
    releases: DataFrame, path: str, checkpoint: str, **sink
) -> StreamingQuery:
    return start_append(
        silver.silver_releases(releases), path, checkpoint, partition_by=["dt"], **sink
    )


def start_serving(
    bars: DataFrame,
    path: str,
    checkpoint: str,
    *,
    late_after: str | None = serving.LATE_AFTER,
    as_of: Column | datetime | str | None = None,
    **sink,
) -> StreamingQuery:
    """Serving rows in hour partitions; late bars are refused per micro-batch."""
    if late_after is not None:
        bars = serving.reject_late(bars, late_after, as_of)
    rows = serving.with_segment(serving.serving_bars(bars))
    return start_append(rows, path, checkpoint, partition_by=["hour"], **sink)


def start_routed(
    events: DataFrame, path: str, checkpoint: str, *, day: Column | None = None, **sink
) -> StreamingQuery:
    """Events to the topic named in each row, on files a folder per topic and ``day``.

    ``day`` is the day of arrival, by default that of the micro-batch. There are two
    topics and few days in a batch, so raw events are not shuffled for the sake of files.
    """
    dated = events.withColumn(DAY, F.current_date() if day is None else day)
    columns = [c for c in ROUTED_EVENT.fieldNames() if c in events.columns]
    return start_append(
        dated.select(*columns, DAY), path, checkpoint, partition_by=["topic", DAY], rebalance=False, **sink
    )


def read_routed(spark: SparkSession, path: str, *, dated: bool = False) -> DataFrame:
    """Routed events from files; a filter on ``topic`` prunes folders, and with ``dated``
    one on the day of arrival, ``dt``."""
    stored = StructType([*ROUTED_EVENT.fields, StructField(DAY, DateType())])
    topics = [name for name in children(spark, path) if name.startswith("topic=")]
    rows = spark.read.schema(stored).parquet(path)
    for name in topics:
        # Each topic has a bound of its own.
        rows = live(spark, rows, f"{path}/{name}", where=F.col("topic") == name.removeprefix("topic="))
    return rows.select(*ROUTED_EVENT.fieldNames(), *([DAY] if dated else []))


# Upserts. Parquet has no merge: every micro-batch writes its own partition of a
# changelog, and readers take the newest version of each key. A batch that is
# run again after a failure overwrites its partition, so it adds nothing twice.


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: list[str] | None = None) -> None:
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by or []).parquet(f"{path}/{BATCH}={batch_id}")


def read_changelog(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All changelog rows with their ``batch_id``; a filter on it prunes folders.

    They are the newest base, if the changelog was compacted, and the batches after it.
    """
    stored = StructType([*schema.fields, StructField(BATCH, LongType())])
    tail, bases = spark.read.schema(stored).parquet(path), _numbers(spark, f"{path}/{_BASE}", "upto")
    if not bases:
        return tail
    base = spark.read.schema(stored).parquet(f"{path}/{_BASE}/upto={bases[-1]}")
    return base.unionByName(tail.where(F.col(BATCH) > bases[-1]))


def _numbers(spark: SparkSession, folder: str, name: str) -> list[int]:
    """The numbers of the finished folders ``name=number``, in order."""
    found = [c for c in children(spark, folder) if c.startswith(f"{name}=")]
    return sorted(int(c.split("=")[1]) for c in found if exists(spark, f"{folder}/{c}/_SUCCESS"))


def compact_changelog(
    spark: SparkSession,
    path: str,
    schema: StructType,
    keys: list[str],
    version: str | Column = BATCH,
    partition_by: list[str] | None = None,
) -> int | None:
    """Fold all batches but the newest into a base with the last version of each key.

    Returns the last batch in the base, None if there was nothing to fold. The stream
    may go on meanwhile: it writes new batches, and may repeat the newest one, which
    stays out. What the base before this one held goes only now, so readers that
    listed it have had a whole round to finish; what is read does not grow with
    history. A compaction that broke off leaves no finished base and is run again.
    """
    batches, bases = _numbers(spark, path, BATCH), _numbers(spark, f"{path}/{_BASE}", "upto")
    if len(batches) < 2 or (bases and batches[-2] <= bases[-1]):
        return None
    upto = batches[-2]
    rows = read_changelog(spark, path, schema).where(F.col(BATCH) <= upto)
    columns = [c for c in [*schema.fieldNames(), BATCH] if c not in keys]
    latest = state.latest_by_key(rows, keys, version, columns)
    if partition_by:
        latest = latest.hint("rebalance", *partition_by)
    latest.write.mode("overwrite").partitionBy(*partition_by or []).parquet(f"{path}/{_BASE}/upto={upto}")
    old = bases[-1] if bases else -1
    gone = [f"{path}/{BATCH}={n}" for n in batches if n <= old] + [f"{path}/{_BASE}/upto={n}" for n in bases[:-1]]
    for folder in gone:
        delete(spark, folder)
    return upto


def read_batch(spark: SparkSession, path: str, schema: StructType, batch_id: int) -> DataFrame:
    """The rows of one batch, without listing the folders of the others."""
    return spark.read.schema(schema).parquet(f"{path}/{BATCH}={batch_id}")


def start_changelog(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: dict | None = None,
    state_partitions: int | None = STATE_PARTITIONS,
) -> StreamingQuery:
    """Upsert sink for a streaming aggregate: the changed keys of each batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    return start_foreach(
        df, write, checkpoint, output_mode="update", trigger=trigger, state_partitions=state_partitions
    )


def start_foreach(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    output_mode: str = "append",
    trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Run ``write`` on each micro-batch.

    Spark turns adaptive execution off in the session of a stateful stream, and the
    rebalance hint is ignored without it: every task would write a file to every folder.
    What happens to a batch that is there is a plain query, so it gets it back.
    """

    def adaptive(batch: DataFrame, batch_id: int) -> None:
        conf, name = batch.sparkSession.conf, "spark.sql.adaptive.enabled"
        before = conf.get(name)
        conf.set(name, "true")
        try:
            write(batch, batch_id)
        finally:
            conf.set(name, before)

    writer = (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or COMMIT_INTERVAL))
        .foreachBatch(adaptive)
    )
    with state_over(df.sparkSession, state_partitions):
        return writer.start()


def start_macro_state(
    releases: DataFrame,
    path: str,
    checkpoint: str,
    *,
    by: str = "arrival",
    arrival: str | Column = "offset",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the latest value per series; each batch writes the series it changed."""
    current = state.latest_state(releases, by=by, arrival=arrival)
    return start_changelog(current, path, checkpoint, trigger=trigger)


def read_macro_state(spark: SparkSession, path: str) -> DataFrame:
    """The current value of each series."""
    changes = read_changelog(spark, path, MACRO_STATE)
    return state.latest_by_key(
        changes, ["series_id"], BATCH, ["macro_value", "release_ts_ms"]
    )
