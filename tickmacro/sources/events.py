"""Event sources: raw text from any connector, decoded by declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickmacro.functions.times import instant
from tickmacro.schemas import RELEASE_EVENT, TICK_EVENT

TICK_LATENESS = "10 seconds"
RELEASE_LATENESS = "5 minutes"
_CORRUPT = "_corrupt_record"


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    """Read a topic from its beginning, committed records only."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
    }


def read_events(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    options: dict[str, str] | None = None,
    *,
    streaming: bool = True,
) -> DataFrame:
    """Raw events with a ``value`` column.

    ``kafka`` also brings key, offset and timestamp. ``text`` reads one event
    per line; its files may arrive while the stream runs.
    """
    reader = (spark.readStream if streaming else spark.read).format(fmt)
    reader = reader.options(**(options or {}))
    raw = reader.load(path) if path else reader.load()
    if fmt == "kafka":
        return raw.select(
            F.col("key").cast("string"),
            F.col("value").cast("string"),
            "partition",
            "offset",
            "timestamp",
        )
    return raw


def _decode(raw: DataFrame, schema: StructType, mode: str, keep: tuple[str, ...]) -> DataFrame:
    event = F.from_json(F.col("value"), schema, {"mode": mode})
    at = instant("event_ts_ms")
    if mode == "FAILFAST":
        # A window would drop an event without a time in silence.
        fault = F.raise_error(F.lit("event without event_ts_ms")).cast("timestamp")
        at = F.when(F.col("event_ts_ms").isNull(), fault).otherwise(at)
    return (
        raw.select(*keep, event.alias("event")).select(*keep, "event.*").withColumn("event_time", at)
    )


def decode_ticks(
    raw: DataFrame,
    *,
    mode: str = "FAILFAST",
    keep: tuple[str, ...] = (),
    lateness: str = TICK_LATENESS,
) -> DataFrame:
    """Tick events with event time and watermark. Malformed JSON and events without
    a time fail the job; run ``route_dead_letters`` first to set them aside."""
    return _decode(raw, TICK_EVENT, mode, keep).withWatermark("event_time", lateness)


def decode_releases(
    raw: DataFrame,
    *,
    mode: str = "FAILFAST",
    keep: tuple[str, ...] = (),
    lateness: str = RELEASE_LATENESS,
) -> DataFrame:
    """Release events with event time and watermark."""
    return _decode(raw, RELEASE_EVENT, mode, keep).withWatermark("event_time", lateness)


def required_fields(schema: StructType) -> list[str]:
    """What an event of this schema can't do without: id, time, and the key and value
    of its payload, the first text and the first number there."""
    payload = schema["payload"].dataType.fields
    key = next(f.name for f in payload if f.dataType.typeName() == "string")
    value = next(f.name for f in payload if f.dataType.typeName() == "double")
    return ["event_id", "event_ts_ms", f"payload.{key}", f"payload.{value}"]


def route_dead_letters(
    raw: DataFrame, schema: StructType, *, topic: str, dead_topic: str
) -> DataFrame:
    """Set ``topic`` per row: text that is not JSON of this schema (by syntax
    or by type), or lacks one of its ``required_fields``, goes to ``dead_topic``,
    unchanged.

    A Kafka sink routes by that column; a file sink partitions by it.
    """
    probe = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    event = F.from_json(
        "value", probe, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    # A column of its own, so that each text is parsed once.
    parsed = raw.withColumn("_event", event)
    malformed = F.col("_event").isNull() | F.col(f"_event.{_CORRUPT}").isNotNull()
    for field in required_fields(schema):
        malformed = malformed | F.col(f"_event.{field}").isNull()
    return parsed.withColumn("topic", F.when(malformed, dead_topic).otherwise(topic)).drop("_event")


def drop_resent(events: DataFrame, keys: list[str], *, lateness: str | None = None) -> DataFrame:
    """Optional: one copy per natural key, for feeds that send a record again.

    With ``lateness`` a stream forgets a key after that time, which bounds its
    state; a batch compares the whole input.
    """
    if events.isStreaming:
        if lateness is not None:
            events = events.withWatermark("event_time", lateness)
        return events.dropDuplicatesWithinWatermark(keys)
    return events.dropDuplicates(keys)
