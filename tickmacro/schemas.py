"""Declared schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, LONG, DOUBLE = StringType(), LongType(), DoubleType()
DATE, INSTANT = DateType(), TimestampType()


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def _event(payload: StructType) -> StructType:
    return _struct(
        event_id=STRING,
        source=STRING,
        entity_key=STRING,
        event_ts_ms=LONG,
        ingest_ts_ms=LONG,
        schema_version=STRING,
        payload=payload,
    )


TICK_EVENT = _event(_struct(symbol=STRING, price=DOUBLE, size=LONG))
RELEASE_EVENT = _event(
    _struct(
        series_id=STRING,
        observation_date=STRING,
        value=DOUBLE,
        release_ts_ms=LONG,
        realtime_start=STRING,
        realtime_end=STRING,
    )
)

BAR = _struct(
    symbol=STRING,
    window_start=INSTANT,
    window_end=INSTANT,
    open_price=DOUBLE,
    high_price=DOUBLE,
    low_price=DOUBLE,
    close_price=DOUBLE,
    volume=LONG,
    tick_count=LONG,
)
MACRO_STATE = _struct(series_id=STRING, macro_value=DOUBLE, release_ts_ms=LONG)
ENRICHED = _struct(
    symbol=STRING,
    window_start=INSTANT,
    close_price=DOUBLE,
    volume=LONG,
    tick_count=LONG,
    series_id=STRING,
    macro_value=DOUBLE,
    release_ts_ms=LONG,
    macro_age_minutes=LONG,
)
SILVER_BAR = _struct(
    dt=DATE,
    bucket_1m_utc=INSTANT,
    symbol=STRING,
    open_price=DOUBLE,
    high_price=DOUBLE,
    low_price=DOUBLE,
    close_price=DOUBLE,
    volume=LONG,
    tick_count=LONG,
)
SILVER_RELEASE = _struct(
    dt=DATE,
    series_id=STRING,
    observation_date=DATE,
    macro_value=DOUBLE,
    release_ts_utc=INSTANT,
    realtime_start=DATE,
    realtime_end=DATE,
)
ALIGNED_DAILY = _struct(
    symbol=STRING,
    close_price=DOUBLE,
    volume=LONG,
    tick_count=LONG,
    macro_value=DOUBLE,
    macro_release_ts_utc=INSTANT,
    dt=DATE,
)
CORRELATION_DAILY = _struct(symbol=STRING, rolling_corr_30d=DOUBLE, dt=DATE)
SERVING_BAR = _struct(
    time=INSTANT,
    symbol=STRING,
    close_price_sum=DOUBLE,
    volume_proxy_sum=LONG,
    tick_count_sum=LONG,
    hour=STRING,
)
ROUTED_EVENT = _struct(key=STRING, value=STRING, topic=STRING)

# Topic names and their retention in days (None: compacted, kept).
TICK_TOPIC = "raw.market.finnhub.tick.v1"
RELEASE_TOPIC = "raw.macro.fred.release.v1"
BAR_TOPIC = "curated.market.bar.1m.v1"
STATE_TOPIC = "state.macro.latest.v1"
ANALYTICS_TOPIC = "analytics.market_macro.1m.v1"
TICK_DEAD_TOPIC = "dlq.raw.market.finnhub.tick.v1"
RELEASE_DEAD_TOPIC = "dlq.raw.macro.fred.release.v1"
# What each keyed topic is keyed by.
TOPIC_KEYS = {
    BAR_TOPIC: ["symbol", "window_start"],
    STATE_TOPIC: ["series_id"],
    ANALYTICS_TOPIC: ["symbol", "window_start", "series_id"],
}
RETENTION_DAYS = {
    TICK_TOPIC: 7,
    RELEASE_TOPIC: 365,
    BAR_TOPIC: 30,
    STATE_TOPIC: None,
    ANALYTICS_TOPIC: 30,
    TICK_DEAD_TOPIC: 14,
    RELEASE_DEAD_TOPIC: 14,
}
