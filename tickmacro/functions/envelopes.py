"""Event envelopes as columns, and their JSON form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SCHEMA_VERSION = "v1"


def _envelope(
    source: Column | str,
    entity_key: Column,
    event_ts_ms: Column,
    payload: Column,
    event_id: Column | None,
    ingest_ts_ms: Column | None,
) -> Column:
    source = source if isinstance(source, Column) else F.lit(source)
    event_id = F.expr("uuid()") if event_id is None else event_id.cast("string")
    if ingest_ts_ms is None:
        ingest_ts_ms = F.unix_millis(F.current_timestamp())
    return F.struct(
        event_id.alias("event_id"),
        source.alias("source"),
        entity_key.alias("entity_key"),
        event_ts_ms.alias("event_ts_ms"),
        ingest_ts_ms.alias("ingest_ts_ms"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        payload.alias("payload"),
    )


def market_envelope(
    source: Column | str,
    *,
    symbol: Column,
    price: Column,
    size: Column,
    event_ts_ms: Column,
    event_id: Column | None = None,
    ingest_ts_ms: Column | None = None,
) -> Column:
    """One tick as an envelope struct; the price is rounded to 4 decimals."""
    payload = F.struct(
        symbol.alias("symbol"), F.round(price, 4).alias("price"), size.alias("size")
    )
    return _envelope(source, symbol, event_ts_ms, payload, event_id, ingest_ts_ms)


def macro_envelope(
    source: Column | str,
    *,
    series_id: Column,
    observation_date: Column,
    value: Column,
    release_ts_ms: Column,
    realtime_start: Column,
    realtime_end: Column,
    event_id: Column | None = None,
    ingest_ts_ms: Column | None = None,
) -> Column:
    """One release as an envelope struct; its event time is the release time."""
    payload = F.struct(
        series_id.alias("series_id"),
        observation_date.alias("observation_date"),
        value.alias("value"),
        release_ts_ms.alias("release_ts_ms"),
        realtime_start.alias("realtime_start"),
        realtime_end.alias("realtime_end"),
    )
    return _envelope(source, series_id, release_ts_ms, payload, event_id, ingest_ts_ms)


def encode_events(df: DataFrame, envelope: Column, topic: str) -> DataFrame:
    """(topic, key, value) rows, ready for a Kafka, JSON or console sink.

    The key is the entity key, so all events of one entity share a partition.
    """
    return df.select(envelope.alias("event")).select(
        F.lit(topic).alias("topic"),
        F.col("event.entity_key").alias("key"),
        F.to_json("event", {"ignoreNullFields": "false"}).alias("value"),
    )


def dry_run_lines(df: DataFrame, envelope: Column, topic: str) -> DataFrame:
    """What would be sent, as one line of JSON per event, for ``console`` or text."""
    return df.select(envelope.alias("event")).select(
        F.to_json(
            F.struct(F.lit(topic).alias("topic"), F.col("event.entity_key").alias("key"), "event"),
            {"ignoreNullFields": "false"},
        ).alias("value")
    )


# Instants as text, to the millisecond and in UTC, in the form SQL writes them.
_INSTANTS = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSS"}


def encode_rows(rows: DataFrame, topic: str, key: list[str]) -> DataFrame:
    """(topic, key, value): table rows as JSON events, ready for any sink.

    The key is a JSON object of the key columns, so a compacted topic keeps the
    last row of each key and all rows of a key share a partition.
    """
    return rows.select(
        F.lit(topic).alias("topic"),
        F.to_json(F.struct(*key), _INSTANTS).alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false", **_INSTANTS}).alias("value"),
    )


def decode_rows(raw: DataFrame, schema: StructType) -> DataFrame:
    """The rows that ``encode_rows`` has written, by their declared schema; text that
    is not such a row fails the job."""
    row = F.from_json("value", schema, {"mode": "FAILFAST", **_INSTANTS})
    return raw.select(row.alias("r")).select("r.*")
