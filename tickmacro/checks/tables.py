"""The given tables read as ticks, releases and service responses.

``events`` plays the minute feed, ``orders`` and ``lineitem`` a feed of several
years. Every row of a table takes part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmacro.functions.envelopes import encode_events, macro_envelope, market_envelope
from tickmacro.functions.times import instant
from tickmacro.schemas import RELEASE_TOPIC, TICK_TOPIC
from tickmacro.session import use_utc

SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
}
EVENT_SERIES = "error"
ORDER_SERIES = "N"


def read_table(
    spark: SparkSession, sf_dir: str, name: str, *, streaming: bool = False
) -> DataFrame:
    schema = SCHEMAS[name]
    if not streaming:
        return use_utc(spark).read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")
    # A file stream takes a folder or a pattern; this pattern names the table,
    # be it one file or a folder of files.
    return use_utc(spark).readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def arrival() -> Column:
    """Events arrived in the order of their ids."""
    return F.col("event_id").cast("bigint")


def _epoch_ms(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _size() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def tick_envelope() -> Column:
    at = _epoch_ms("ts")
    return market_envelope(
        "events",
        symbol=F.col("event_type"),
        price=F.col("value"),
        size=_size(),
        event_ts_ms=at,
        event_id=F.col("event_id"),
        ingest_ts_ms=at,
    )


def tick_events(events: DataFrame) -> DataFrame:
    """(topic, key, value) of all rows as ticks; id and ingest time are the row's own."""
    return encode_events(events, tick_envelope(), TICK_TOPIC)


def release_events(events: DataFrame) -> DataFrame:
    at, day = _epoch_ms("ts"), F.date_format("ts", "yyyy-MM-dd")
    envelope = macro_envelope(
        "events",
        series_id=F.col("event_type"),
        observation_date=day,
        value=F.col("value"),
        release_ts_ms=at,
        realtime_start=day,
        realtime_end=day,
        event_id=F.col("event_id"),
        ingest_ts_ms=at,
    )
    return encode_events(events, envelope, RELEASE_TOPIC)


def _spoilt(good: Column, wrong_type: Column, timeless: Column, empty: Column) -> Column:
    """``signup`` rows carry text as a number, ``error`` rows end too early; of the others
    ids that end in 3 have no time, those in 7 no payload."""
    last = F.col("event_id") % 10
    return (
        F.when(F.col("event_type") == "signup", wrong_type)
        .when(F.col("event_type") == "error", F.left(good, F.length(good) - 3))
        .when(last == 3, timeless)
        .when(last == 7, empty)
        .otherwise(good)
    )


def mixed_events(
    events: DataFrame, *keep: Column, payload: Callable[[Column], Column] | None = None
) -> DataFrame:
    """(key, value) of all rows as ticks, some of them spoilt, and what ``keep`` adds.

    ``payload`` makes the payload of another kind from its number.
    """
    payload = payload or (
        lambda price: F.struct(
            F.col("event_type").alias("symbol"), price.alias("price"), _size().alias("size")
        )
    )

    def event(number: Column, at: Column | None = _epoch_ms("ts"), full: bool = True) -> Column:
        fields = [F.col("event_id").cast("string").alias("event_id")]
        fields += [at.alias("event_ts_ms")] if at is not None else []
        fields += [payload(number).alias("payload")] if full else []
        return F.to_json(F.struct(*fields))

    number = F.col("value")
    value = _spoilt(
        event(number), event(F.concat(F.lit("x"), number)), event(number, None), event(number, full=False)
    )
    return events.select(F.col("event_id").cast("string").alias("key"), value.alias("value"), *keep)


def mixed_releases(events: DataFrame, *keep: Column) -> DataFrame:
    """The same as releases."""
    return mixed_events(
        events, *keep, payload=lambda v: F.struct(F.col("event_type").alias("series_id"), v.alias("value"))
    )


def mixed_responses(events: DataFrame) -> DataFrame:
    """(key, kind, series_id, symbol, body) of all rows as quote and as observation
    responses, some of them spoilt: no number, cut off, an error page, no time or date."""
    day, at = F.date_format("ts", "yyyy-MM-dd"), F.unix_seconds(F.col("ts").cast("timestamp"))
    quote = lambda **f: F.to_json(F.struct(*[c.alias(k) for k, c in f.items()]))
    page = F.lit("<html>error</html>")
    c = F.col("value")
    quotes = _spoilt(quote(c=c, t=at), quote(c=F.concat(F.lit("x"), c), t=at), quote(c=c), page)

    def listed(**f: Column) -> Column:
        return F.to_json(F.struct(F.array(F.struct(*[c.alias(k) for k, c in f.items()])).alias("observations")))

    text = c.cast("decimal(18,2)").cast("string")
    observations = _spoilt(listed(date=day, value=text), F.lit("[1"), listed(value=text), page)
    both = F.explode(F.create_map(F.lit("quote"), quotes, F.lit("observations"), observations))
    return events.select(
        F.col("event_id").cast("string").alias("key"),
        F.col("event_type").alias("series_id"),
        F.col("event_type").alias("symbol"),
        both.alias("kind", "body"),
    )


def event_ticks(events: DataFrame) -> DataFrame:
    """All rows as ticks in decoded form, without the way through JSON."""
    at = _epoch_ms("ts")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        at.alias("event_ts_ms"),
        F.struct(
            F.col("event_type").alias("symbol"),
            F.col("value").alias("price"),
            _size().alias("size"),
        ).alias("payload"),
        instant(at).alias("event_time"),
    )


def event_releases(events: DataFrame) -> DataFrame:
    at, day = _epoch_ms("ts"), F.date_format("ts", "yyyy-MM-dd")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        at.alias("event_ts_ms"),
        F.struct(
            F.col("event_type").alias("series_id"),
            day.alias("observation_date"),
            F.col("value").alias("value"),
            at.alias("release_ts_ms"),
            day.alias("realtime_start"),
            day.alias("realtime_end"),
        ).alias("payload"),
        instant(at).alias("event_time"),
    )


def order_ticks(orders: DataFrame) -> DataFrame:
    at = _epoch_ms("o_orderdate")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("event_id"),
        F.struct(
            F.col("o_orderpriority").alias("symbol"),
            F.col("o_totalprice").alias("price"),
            F.lit(1).cast("bigint").alias("size"),
        ).alias("payload"),
        instant(at).alias("event_time"),
    )


def shipment_releases(lineitem: DataFrame) -> DataFrame:
    at, day = _epoch_ms("l_shipdate"), F.date_format("l_shipdate", "yyyy-MM-dd")
    return lineitem.select(
        F.struct(
            F.col("l_returnflag").alias("series_id"),
            day.alias("observation_date"),
            F.col("l_extendedprice").alias("value"),
            at.alias("release_ts_ms"),
            day.alias("realtime_start"),
            day.alias("realtime_end"),
        ).alias("payload")
    )


def observation_responses(events: DataFrame) -> DataFrame:
    """(series_id, body): each event as one response of four observations, with
    a missing marker, no value, no release day and an empty release day."""
    day = F.date_format("ts", "yyyy-MM-dd")
    text = F.col("value").cast("decimal(18,2)").cast("string")

    def observation(value: Column, start: Column, end: Column) -> Column:
        return F.struct(
            day.alias("date"),
            value.alias("value"),
            start.alias("realtime_start"),
            end.alias("realtime_end"),
        )

    none = F.lit(None).cast("string")
    later = F.date_format(F.date_add("ts", 1), "yyyy-MM-dd")
    listed = F.array(
        observation(text, later, later),
        observation(F.lit("."), later, later),
        observation(none, later, later),
        observation(text, F.lit(""), none),
    )
    # NULL fields are left out of the text, so they are absent, not null.
    body = F.to_json(F.struct(listed.alias("observations")))
    return events.select(F.col("event_type").alias("series_id"), body.alias("body"))


def quote_responses(events: DataFrame) -> DataFrame:
    body = F.to_json(
        F.struct(
            F.col("value").alias("c"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("t")
        )
    )
    return events.select(F.col("event_type").alias("symbol"), body.alias("body"))


def as_ntz(df: DataFrame) -> DataFrame:
    """Timestamps without zone, the type the SQL side reports."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def part_in_time(events: DataFrame, parts: int = 4) -> Column:
    """The number of the part that a row falls in, by equal spans of time.

    The two ends are found here, once for all parts that are written.
    """
    at = _epoch_ms("ts")
    low, high = [F.lit(end).cast("bigint") for end in events.agg(F.min(at), F.max(at)).first()]
    return F.least(F.lit(parts - 1), F.floor((at - low) * parts / F.greatest(high - low, F.lit(1)))).cast("int")


def write_parts(events: DataFrame, path: str, arrives: Column, which: list[int], files: int = 8) -> None:
    """Land the rows of the parts ``which``, one part after the other, in ``files`` files
    each at most. ``arrives`` tells the part that a row comes with."""
    marked = events.withColumn("_part", arrives)
    for n in which:
        marked.where(F.col("_part") == n).drop("_part").repartition(files).write.mode("append").parquet(path)


def write_closing(events: DataFrame, path: str) -> None:
    """Land one tick a day after the last; it closes all windows before it and is in none
    that closes."""
    closing = events.select(
        *[F.max(c).alias(c) if c != "ts" else (F.max(c) + F.expr("INTERVAL 1 DAY")).alias(c) for c in events.columns]
    )
    closing.write.mode("append").parquet(path)


def follow(events: DataFrame, path: str, files: int = 8) -> DataFrame:
    """What lands at ``path`` as a stream, a part for each trigger."""
    stream = events.sparkSession.readStream.schema(events.schema).option("maxFilesPerTrigger", files)
    return stream.parquet(path)


def parts_in_time(events: DataFrame, path: str, parts: int = 4, files: int = 8) -> DataFrame:
    """``events`` as a stream that brings them in order of time, a part for each trigger,
    and the closing tick at last."""
    write_parts(events, path, part_in_time(events, parts), list(range(parts)), files)
    write_closing(events, path)
    return follow(events, path, files)


#: Of the rows of these, as the last digits of ids, the first come one part late, the second two.
LATE_BY_ONE, LATE_BY_TWO = 4, 8
PARTS = 6


def late_arrival(events: DataFrame, parts: int = PARTS) -> Column:
    """The part that a row comes with if a fifth of the rows come late: one part or two,
    and with the closing tick where the parts end before."""
    last, own = F.col("event_id") % 10, part_in_time(events, parts)
    late = F.when(last == LATE_BY_ONE, 1).when(last == LATE_BY_TWO, 2).otherwise(0)
    return F.least(own + late, F.lit(parts))
