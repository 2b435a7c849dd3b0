"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickmacro import files
from tickmacro.checks import tables as t
from tickmacro.functions.envelopes import decode_rows, dry_run_lines, encode_rows
from tickmacro.operators import bars, daily, enrich, retention, serving, silver, state
from tickmacro.plans import gold, reports
from tickmacro.schemas import (
    ANALYTICS_TOPIC,
    BAR,
    BAR_TOPIC,
    ENRICHED,
    MACRO_STATE,
    RELEASE_DEAD_TOPIC,
    RELEASE_EVENT,
    RELEASE_TOPIC,
    SERVING_BAR,
    SILVER_BAR,
    SILVER_RELEASE,
    STATE_TOPIC,
    TICK_DEAD_TOPIC,
    TICK_EVENT,
    TICK_TOPIC,
    TOPIC_KEYS,
)
from tickmacro.session import new_dir
from tickmacro.sources import events as event_sources
from tickmacro.sources import responses
from tickmacro.sources import tables as table_sources
from tickmacro.streaming import enrichment, jobs, merging

Query = Callable[[SparkSession, str], DataFrame]
ONCE = {"availableNow": True}
ROUND = 9


def _events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    return t.read_table(spark, sf_dir, "events", streaming=streaming)


def _ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.event_ticks(_events(spark, sf_dir))


def _releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.event_releases(_events(spark, sf_dir))


def _bars(spark: SparkSession, sf_dir: str, interval: str = "1 minute", **kw) -> DataFrame:
    return bars.build_bars(_ticks(spark, sf_dir), interval, **kw)


def _silver_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_bars(_bars(spark, sf_dir))


def _silver_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_releases(_releases(spark, sf_dir))


def _order_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = t.order_ticks(t.read_table(spark, sf_dir, "orders"))
    return daily.market_daily(silver.silver_bars(bars.build_bars(ticks)))


def _order_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipments = t.shipment_releases(t.read_table(spark, sf_dir, "lineitem"))
    return daily.align_daily(
        _order_daily(spark, sf_dir), silver.silver_releases(shipments), t.ORDER_SERIES
    )


def _event_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.align_daily(
        daily.market_daily(_silver_bars(spark, sf_dir)),
        _silver_releases(spark, sf_dir),
        t.EVENT_SERIES,
    )


def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, ROUND))


# Decoding and envelopes


def raw_tick_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = event_sources.decode_ticks(t.tick_events(_events(spark, sf_dir)))
    columns = [c for c in ticks.columns if c != "payload"]
    return t.as_ntz(ticks.select(*columns, "payload.*"))


def raw_macro_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    releases = event_sources.decode_releases(t.release_events(_events(spark, sf_dir)))
    columns = [c for c in releases.columns if c != "payload"]
    return t.as_ntz(releases.select(*columns, "payload.*"))


def _envelope_fields(events: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Read the JSON text by path, apart from the decoder."""
    return events.select(
        "topic",
        "key",
        *[
            F.get_json_object("value", f"$.{path}").cast(kind).alias(path.replace(".", "_"))
            for path, kind in fields.items()
        ],
    )


_HEAD = {
    "event_id": "string",
    "source": "string",
    "entity_key": "string",
    "event_ts_ms": "bigint",
    "ingest_ts_ms": "bigint",
    "schema_version": "string",
}


def market_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = {f"payload.{f.name}": f.dataType.simpleString() for f in TICK_EVENT["payload"].dataType}
    return _envelope_fields(t.tick_events(_events(spark, sf_dir)), _HEAD | payload)


def macro_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = {
        f"payload.{f.name}": f.dataType.simpleString() for f in RELEASE_EVENT["payload"].dataType
    }
    return _envelope_fields(t.release_events(_events(spark, sf_dir)), _HEAD | payload)


def _routed(events: DataFrame) -> DataFrame:
    return event_sources.route_dead_letters(
        t.mixed_events(events), TICK_EVENT, topic=TICK_TOPIC, dead_topic=TICK_DEAD_TOPIC
    )


def _routed_fields(routed: DataFrame) -> DataFrame:
    """Good rows decoded, dead rows as they came."""
    good = F.col("topic") == TICK_TOPIC
    price = F.when(good, F.get_json_object("value", "$.payload.price").cast("double"))
    return routed.select("key", "topic", price.alias("price"))


def dead_letter_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed_fields(_routed(_events(spark, sf_dir)))


def raw_tick_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = event_sources.decode_ticks(t.tick_events(_events(spark, sf_dir)))
    columns = [c for c in ticks.columns if c not in ("payload", "event_time")]
    return reports.event_sample(ticks).select(*columns, "payload.*")


def fred_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = t.observation_responses(_events(spark, sf_dir))
    series = responses.parse_series("error, signup,,view ")
    return responses.observations(responses.raw_observations(landed, series))


def fred_observations_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = responses.raw_observations(t.observation_responses(_events(spark, sf_dir)))
    return responses.observations(responses.newest_observations(listed, 200))


def finnhub_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.quotes(t.quote_responses(_events(spark, sf_dir)))


def response_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every response once: a broken one as dead, a good one with what it says."""
    landed = t.mixed_responses(_events(spark, sf_dir))
    quoted = responses.split_quotes(landed.where("kind = 'quote'"))
    listed = responses.split_observations(landed.where("kind = 'observations'"))
    price = responses.quotes(quoted.where(~F.col("dead")).withColumn("symbol", F.col("key")))
    value = responses.raw_observations(
        listed.where(~F.col("dead")).withColumn("series_id", F.col("key"))
    )
    good = price.select(F.col("symbol").alias("key"), F.lit("quote").alias("kind"), "price").union(
        value.select("series_id", F.lit("observations"), F.col("value").cast("double"))
    )
    dead = [rows.where("dead").select("key", "kind", F.lit(None).cast("double")) for rows in (quoted, listed)]
    return good.withColumn("dead", F.lit(False)).union(dead[0].union(dead[1]).withColumn("dead", F.lit(True)))


def release_dead_letter_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = event_sources.route_dead_letters(
        t.mixed_releases(_events(spark, sf_dir)),
        RELEASE_EVENT,
        topic=RELEASE_TOPIC,
        dead_topic=RELEASE_DEAD_TOPIC,
    )
    good = F.col("topic") == RELEASE_TOPIC
    value = F.when(good, F.get_json_object("value", "$.payload.value").cast("double"))
    return routed.select("key", "topic", value.alias("value"))


def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a dry run, read back by path."""
    envelope = t.tick_envelope()
    lines = dry_run_lines(_events(spark, sf_dir), envelope, TICK_TOPIC)
    field = lambda path: F.get_json_object("value", f"$.{path}")
    return lines.select(
        field("topic").alias("topic"),
        field("key").alias("key"),
        field("event.event_id").alias("event_id"),
        field("event.payload.price").cast("double").alias("price"),
    )


# Bars and state


def market_bar_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.as_ntz(_bars(spark, sf_dir))


def market_bar_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.as_ntz(_bars(spark, sf_dir, "1 hour"))


def market_bar_true_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.as_ntz(_bars(spark, sf_dir, "1 hour", ohlc="event_time"))


def macro_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest_state(_releases(spark, sf_dir), arrival=t.arrival())


def enriched_market_macro_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.as_ntz(
        enrich.enrich(_bars(spark, sf_dir), macro_latest_state(spark, sf_dir), t.EVENT_SERIES)
    )


def enriched_proc_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched rows whose processing time lies within the run; it is dropped then."""
    began = F.lit(datetime.now(timezone.utc))
    rows = enrich.enrich(
        _bars(spark, sf_dir), macro_latest_state(spark, sf_dir), t.EVENT_SERIES, proc_time=True
    )
    return t.as_ntz(rows.where(F.col("proc_time").between(began, F.current_timestamp())).drop("proc_time"))


def silver_market_bar_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.as_ntz(_silver_bars(spark, sf_dir))


def silver_macro_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.as_ntz(_silver_releases(spark, sf_dir))


# Gold


def market_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.market_daily(_silver_bars(spark, sf_dir))


def market_daily_multiyear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_daily(spark, sf_dir)


def market_macro_aligned_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.as_ntz(_event_aligned(spark, sf_dir))


def market_macro_aligned_daily_multiyear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.as_ntz(_order_aligned(spark, sf_dir))


def market_macro_correlation_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(daily.correlation_daily(_event_aligned(spark, sf_dir)), "rolling_corr_30d")


def market_macro_correlation_daily_multiyear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(daily.correlation_daily(_order_aligned(spark, sf_dir)), "rolling_corr_30d")


def correlation_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    correlation = daily.correlation_daily(_order_aligned(spark, sf_dir))
    return _rounded(reports.correlation_latest(correlation, "1-URGENT"), "rolling_corr_30d")


def avg_corr_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    correlation = daily.correlation_daily(_order_aligned(spark, sf_dir))
    return _rounded(reports.avg_corr_by_symbol(correlation), "avg_corr_30d")


def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write silver, refresh the gold tables from it, and count them."""
    root = new_dir(spark, "gold")
    paths = {"bars_path": f"{root}/silver/bars", "releases_path": f"{root}/silver/releases"}
    for rows, path in zip(
        (_silver_bars(spark, sf_dir), _silver_releases(spark, sf_dir)), paths.values()
    ):
        rows.hint("rebalance", "dt").write.partitionBy("dt").parquet(path)
    built = gold.refresh_gold(
        spark,
        database="market_check",
        location=f"{root}/gold",
        series_id=t.EVENT_SERIES,
        **paths,
    )
    return reports.row_counts(built)


def gold_refresh_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after some bars of one day and the releases of another came late, refreshed
    before and after: alignment and correlation side by side. Days that the late rows
    don't bear on must keep their files."""
    root = new_dir(spark, "gold-days")
    where = {"bars_path": f"{root}/silver/bars", "releases_path": f"{root}/silver/releases"}
    first = F.to_date(_ticks(spark, sf_dir).agg(F.min("event_time")).scalar())
    late_bar = (F.col("dt") == F.date_add(first, 8)) & (F.hour("bucket_1m_utc") >= 13)
    late_release = (F.col("dt") == F.date_add(first, 20)) & (F.col("series_id") == t.EVENT_SERIES)
    kept: list[dict] = []
    for late in (False, True):
        for rows, path, held in (
            (_silver_bars(spark, sf_dir), where["bars_path"], late_bar),
            (_silver_releases(spark, sf_dir), where["releases_path"], late_release),
        ):
            part = rows.where(held if late else ~held).hint("rebalance", "dt")
            part.write.mode("append").partitionBy("dt").parquet(path)
        built = gold.refresh_gold_incremental(
            spark, database="market_days", location=f"{root}/gold", series_id=t.EVENT_SERIES, **where
        )
        kept.append({name: files.data_files(spark, f"{root}/gold/{name}") for name in built})
    days = sorted({name.split("/")[0] for name in kept[0][gold.BARS]})
    same = {name: {f for f in kept[0][name] if kept[1][name].get(f) == kept[0][name][f]} for name in kept[0]}
    spared = {
        gold.BARS: [d for n, d in enumerate(days) if n != 8],
        gold.RELEASES: [d for n, d in enumerate(days) if n != 20],
        gold.ALIGNED: [d for n, d in enumerate(days) if n not in (8, 20)],
        gold.CORRELATION: days[:8],
    }
    for name, of in spared.items():
        if not {f for f in kept[0][name] if f.split("/")[0] in of} <= same[name]:
            raise AssertionError(f"files of untouched days of {name} were written again")
    both = built[gold.ALIGNED].join(built[gold.CORRELATION], ["symbol", "dt"])
    return t.as_ntz(_rounded(both, "rolling_corr_30d"))


# Reports, serving, retention


def monitor_recent_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.as_ntz(reports.recent_bars(_silver_bars(spark, sf_dir)))


def monitor_recent_bars_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over a stored table, reading only its newest days."""
    path = new_dir(spark, "silver")
    _silver_bars(spark, sf_dir).hint("rebalance", "dt").write.partitionBy("dt").parquet(path)
    stored = table_sources.silver_bars(spark, path)
    return t.as_ntz(reports.recent_bars(stored, by_day=True))


def monitor_close_timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _silver_bars(spark, sf_dir)
    ms = F.unix_millis("event_time")
    middle = F.timestamp_millis(F.floor((F.min(ms) + F.max(ms)) / 2))
    as_of = _ticks(spark, sf_dir).agg(F.date_trunc("minute", middle)).scalar()
    return _rounded(t.as_ntz(reports.close_timeseries(rows, as_of=as_of)), "avg_close_price")


def serving_bar_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.as_ntz(serving.with_segment(serving.serving_bars(_bars(spark, sf_dir))))


def serving_bar_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolled up from 10-second bars, so that rows of one minute do merge."""
    return t.as_ntz(
        _rounded(
            serving.serving_bars(_bars(spark, sf_dir, "10 seconds"), rollup=True),
            "close_price_sum",
        )
    )


def serving_late_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = _ticks(spark, sf_dir).agg(F.max("event_time")).scalar()
    return t.as_ntz(
        serving.serving_bars(serving.reject_late(_bars(spark, sf_dir), as_of=newest))
    )


def retention_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = _ticks(spark, sf_dir).agg(F.max("event_time")).scalar()
    kept = retention.keep_recent(serving.serving_bars(_bars(spark, sf_dir)), "time", 7, newest)
    return t.as_ntz(kept)


def retention_keep_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = _ticks(spark, sf_dir).agg(F.max("event_time")).scalar()
    return t.as_ntz(retention.keep_recent_days(_silver_bars(spark, sf_dir), 7, newest))


def changelog_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as a changelog of (user, type) in four batches, compacted after each
    of the last two, and read as the last of each key."""
    keys = ["user_id", "event_type"]
    changes = _events(spark, sf_dir).select(*keys, "event_id", "value", "props")
    path, batches = new_dir(spark, "changelog"), 4
    ends = changes.agg(F.max("event_id").alias("e")).scalar() + 1
    for n in range(batches):
        part = changes.where(F.floor(F.col("event_id") * batches / ends) == n)
        jobs.write_batch(state.latest_by_key(part, keys, "event_id"), path, n)
        if n >= batches - 2:
            jobs.compact_changelog(spark, path, changes.schema, keys)
    rows = jobs.read_changelog(spark, path, changes.schema)
    return state.latest_by_key(rows, keys, jobs.BATCH, changes.columns[2:])


def _through_json(rows: DataFrame, topic: str, schema: StructType) -> DataFrame:
    """Rows as keyed JSON events and back; the key must say what the row says."""
    events = encode_rows(rows, topic, TOPIC_KEYS[topic])
    key = StructType([f for f in schema if f.name in TOPIC_KEYS[topic]])
    keys = decode_rows(events.select(F.col("key").alias("value")), key)
    back = decode_rows(events, schema)
    return t.as_ntz(back.join(keys.distinct(), TOPIC_KEYS[topic]).select(*schema.fieldNames()))


def curated_bar_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_json(_bars(spark, sf_dir), BAR_TOPIC, BAR)


def state_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_json(macro_latest_state(spark, sf_dir), STATE_TOPIC, MACRO_STATE)


def enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich.enrich(_bars(spark, sf_dir), macro_latest_state(spark, sf_dir), t.EVENT_SERIES)
    return _through_json(rows, ANALYTICS_TOPIC, ENRICHED)


# Streams: the tables are read as streams, run to their end, and the sink is read.


def _tick_stream(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """The table in order of time, one part for each micro-batch, with a closing tick."""
    return _as_ticks(t.parts_in_time(_events(spark, sf_dir), f"{root}/parts"))


def _as_ticks(events: DataFrame) -> DataFrame:
    return event_sources.decode_ticks(t.tick_events(events))


def _as_releases(events: DataFrame) -> DataFrame:
    return event_sources.decode_releases(t.release_events(events))


def _release_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_releases(_events(spark, sf_dir, streaming=True))


def _run_bars(spark: SparkSession, sf_dir: str, root: str) -> str:
    ticks = _tick_stream(spark, sf_dir, root)
    jobs.start_bars(ticks, f"{root}/bars", f"{root}/run/bars", trigger=ONCE).awaitTermination()
    return f"{root}/bars"


def _lose_commit(spark: SparkSession, checkpoint: str) -> None:
    """As after a crash between the write and the commit of the last batch: it runs again."""
    last = max(int(name) for name in files.children(spark, f"{checkpoint}/commits") if name.isdigit())
    files.delete(spark, f"{checkpoint}/commits/{last}")


def market_bar_1m_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_dir(spark, "bars")
    return t.as_ntz(table_sources.read_bars(spark, _run_bars(spark, sf_dir, root)))


def silver_market_bar_1m_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_dir(spark, "silver-bars")
    rows = table_sources.read_bars(spark, _run_bars(spark, sf_dir, root), streaming=True)
    jobs.start_silver_bars(
        rows, f"{root}/silver", f"{root}/run/silver", trigger=ONCE
    ).awaitTermination()
    return t.as_ntz(table_sources.silver_bars(spark, f"{root}/silver"))


def _external(spark: SparkSession, table: str, schema: StructType, path: str) -> DataFrame:
    """The rows of a folder that a catalog table and a scan by path both have."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    table_sources.create_external_table(spark, table, schema, path)
    by_path = table_sources.silver_bars if schema is SILVER_BAR else table_sources.silver_releases
    return spark.table(table).select(*schema.fieldNames()).intersectAll(by_path(spark, path))


def external_stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver bars that the stream wrote in several batches, the last one twice, read by a
    catalog table and by path."""
    root = new_dir(spark, "external-bars")
    rows = table_sources.read_bars(spark, _run_bars(spark, sf_dir, root), streaming=True, max_files=8)
    for n in range(2):
        if n:
            _lose_commit(spark, f"{root}/run/silver")
        jobs.start_silver_bars(rows, f"{root}/silver", f"{root}/run/silver", trigger=ONCE).awaitTermination()
    return t.as_ntz(_external(spark, "market_stream_bars", SILVER_BAR, f"{root}/silver"))


def external_release_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for releases."""
    root = new_dir(spark, "external-releases")
    releases = _as_releases(t.parts_in_time(_events(spark, sf_dir), f"{root}/parts"))
    for n in range(2):
        if n:
            _lose_commit(spark, f"{root}/run/silver")
        jobs.start_silver_releases(releases, f"{root}/silver", f"{root}/run/silver", trigger=ONCE).awaitTermination()
    found = _external(spark, "market_stream_releases", SILVER_RELEASE, f"{root}/silver")
    closing = _events(spark, sf_dir).agg(F.max("ts")).scalar()
    return t.as_ntz(found.where(F.col("release_ts_utc") <= closing))


def restart_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of half the parts, a lost commit, and the rest after a start from the checkpoint."""
    root, events = new_dir(spark, "restart"), _events(spark, sf_dir)
    part, half = t.part_in_time(events, t.PARTS), t.PARTS // 2
    for n, which in enumerate((range(half), range(half, t.PARTS))):
        t.write_parts(events, f"{root}/parts", part, list(which))
        if n:
            t.write_closing(events, f"{root}/parts")
            _lose_commit(spark, f"{root}/run/bars")
        ticks = _as_ticks(t.follow(events, f"{root}/parts"))
        jobs.start_bars(ticks, f"{root}/bars", f"{root}/run/bars", trigger=ONCE).awaitTermination()
    return t.as_ntz(table_sources.read_bars(spark, f"{root}/bars"))


def late_tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of a stream in which a fifth of the ticks come late, with the ticks that came
    and those that were dropped as the query's progress tells them."""
    root, events = new_dir(spark, "late"), _events(spark, sf_dir)
    t.write_parts(events, f"{root}/parts", t.late_arrival(events), list(range(t.PARTS + 1)))
    t.write_closing(events, f"{root}/parts")
    ticks = _as_ticks(t.follow(events, f"{root}/parts"))
    query = jobs.start_bars(ticks, f"{root}/bars", f"{root}/run/bars", trigger=ONCE)
    query.awaitTermination()
    told = jobs.tick_account(query)
    # The closing tick is in and its window is open.
    came = told["ticks"] - 1
    return t.as_ntz(table_sources.read_bars(spark, f"{root}/bars")).select(
        "*", F.lit(came).cast("bigint").alias("ticks"), F.lit(came - told["in_bars"]).cast("bigint").alias("ticks_dropped")
    )


def retention_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the streams wrote for every topic, expired, and one more batch after it.

    A row for each topic and day that is left, with the number of its rows and a sum: of ids,
    ticks or volumes.
    """
    root, events = new_dir(spark, "expiring"), _events(spark, sf_dir)
    part, day = t.part_in_time(events, t.PARTS), F.to_date("ts").alias("day")
    newest = events.agg(F.to_date(F.max("ts"))).first()[0]
    raw = {"ticks": (t.mixed_events, TICK_EVENT, TICK_TOPIC, TICK_DEAD_TOPIC)}
    raw["releases"] = (t.mixed_releases, RELEASE_EVENT, RELEASE_TOPIC, RELEASE_DEAD_TOPIC)
    folders = {
        **{topic: f"{root}/{kind}/topic={topic}" for kind, (*_, good, dead) in raw.items() for topic in (good, dead)},
        BAR_TOPIC: f"{root}/bars",
        ANALYTICS_TOPIC: f"{root}/enriched/out",
    }
    for which in (range(t.PARTS - 1), [t.PARTS - 1]):
        t.write_parts(events, f"{root}/parts", part, list(which))
        if t.PARTS - 1 in which:
            t.write_closing(events, f"{root}/parts")
        stream = t.follow(events, f"{root}/parts")
        running = [
            jobs.start_routed(
                event_sources.route_dead_letters(mix(stream, day), schema, topic=good, dead_topic=dead),
                f"{root}/{kind}",
                f"{root}/run/{kind}",
                day=F.col("day"),
                trigger=ONCE,
            )
            for kind, (mix, schema, good, dead) in raw.items()
        ]
        running.append(jobs.start_bars(_as_ticks(stream), f"{root}/bars", f"{root}/run/bars", trigger=ONCE))
        for query in running:
            query.awaitTermination()
        enrichment.start_enrichment(
            table_sources.read_bars(spark, f"{root}/bars", streaming=True),
            _as_releases(stream),
            f"{root}/enriched",
            f"{root}/run/enriched",
            arrival=t.arrival(),
            series_id=t.EVENT_SERIES,
            trigger=ONCE,
        ).awaitTermination()
        # Expired once in between, with a batch to come, and once at the end.
        retention.expire_topics(spark, folders, newest, grace=timedelta(0))
    routed = [
        jobs.read_routed(spark, f"{root}/{kind}", dated=True).select("topic", "dt", F.col("key").cast("bigint").alias("size"))
        for kind in raw
    ]
    others = [
        table_sources.read_bars(spark, folders[BAR_TOPIC]).select(
            F.lit(BAR_TOPIC).alias("topic"), F.to_date("window_start").alias("dt"), F.col("tick_count").alias("size")
        ),
        enrichment.read_enriched(spark, f"{root}/enriched").select(
            F.lit(ANALYTICS_TOPIC).alias("topic"), F.to_date("window_start").alias("dt"), F.col("volume").alias("size")
        ),
    ]
    rows = reduce(DataFrame.union, [*routed, *others]).where(F.col("dt") <= F.lit(newest))
    return rows.groupBy("topic", "dt").agg(F.count("*").alias("n"), F.sum("size").cast("bigint").alias("total"))


def silver_macro_release_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_dir(spark, "silver-releases")
    jobs.start_silver_releases(
        _release_stream(spark, sf_dir), f"{root}/silver", f"{root}/run/silver", trigger=ONCE
    ).awaitTermination()
    return t.as_ntz(table_sources.silver_releases(spark, f"{root}/silver"))


def macro_latest_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_dir(spark, "state")
    jobs.start_macro_state(
        _release_stream(spark, sf_dir),
        f"{root}/state",
        f"{root}/run/state",
        arrival=t.arrival(),
        trigger=ONCE,
    ).awaitTermination()
    return jobs.read_macro_state(spark, f"{root}/state")


def enriched_market_macro_1m_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_dir(spark, "enriched")
    rows = table_sources.read_bars(spark, _run_bars(spark, sf_dir, root), streaming=True, max_files=1)
    events = _events(spark, sf_dir)
    t.write_parts(events, f"{root}/releases", t.part_in_time(events), list(range(4)))
    enrichment.start_enrichment(
        rows,
        _as_releases(t.follow(events, f"{root}/releases")),
        f"{root}/enriched",
        f"{root}/run/enriched",
        arrival=t.arrival(),
        series_id=t.EVENT_SERIES,
        trigger=ONCE,
    ).awaitTermination()
    emitted = enrichment.emissions(spark, f"{root}/enriched")
    if emitted.where("versions > 1").isEmpty():
        raise AssertionError("no bar was emitted again after its series changed")
    return t.as_ntz(enrichment.read_enriched(spark, f"{root}/enriched"))


def serving_bar_minute_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_dir(spark, "serving")
    rows = table_sources.read_bars(spark, _run_bars(spark, sf_dir, root), streaming=True)
    jobs.start_serving(
        rows, f"{root}/serving", f"{root}/run/serving", late_after=None, trigger=ONCE
    ).awaitTermination()
    return t.as_ntz(serving.read_serving(spark, f"{root}/serving"))


def segments_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving rows that a stream appends in many micro-batches, merged by segment after each
    half; a reader that listed the files before a swap must see what it saw."""
    root, events = new_dir(spark, "segments"), _events(spark, sf_dir)
    part, half, path = t.part_in_time(events, t.PARTS), t.PARTS // 2, f"{root}/serving"
    for which in (range(half), range(half, t.PARTS)):
        t.write_parts(events, f"{root}/parts", part, list(which))
        if t.PARTS - 1 in which:
            t.write_closing(events, f"{root}/parts")
        ticks = _as_ticks(t.follow(events, f"{root}/parts"))
        jobs.start_bars(ticks, f"{root}/bars", f"{root}/run/bars", trigger=ONCE).awaitTermination()
        # Ten days share a segment, so that several batches meet in it.
        rows = table_sources.read_bars(spark, f"{root}/bars", streaming=True, max_files=4)
        segment = F.date_format("time", "yyyy-MM-dd").substr(1, 9)
        served = serving.serving_bars(rows).withColumn("hour", segment)
        jobs.start_append(
            served, path, f"{root}/run/serving", partition_by=["hour"], trigger=ONCE
        ).awaitTermination()
        before = serving.read_serving(spark, path)
        merging.merge_folders(spark, path, SERVING_BAR, "hour", least=2)
        if before.count() != serving.read_serving(spark, path).count():
            raise AssertionError("a reader of the files before the swap lost or doubled rows")
    if max(merging.live_files(spark, path, "hour").values()) > 2:
        raise AssertionError("a merged folder has more files than it should")
    return t.as_ntz(serving.read_serving(spark, path).drop("hour"))


def dead_letter_split_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_dir(spark, "routed")
    jobs.start_routed(
        _routed(_events(spark, sf_dir, streaming=True)),
        f"{root}/events",
        f"{root}/run/events",
        trigger=ONCE,
    ).awaitTermination()
    return _routed_fields(jobs.read_routed(spark, f"{root}/events"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        raw_tick_decode,
        raw_macro_decode,
        market_envelope,
        macro_envelope,
        dead_letter_split,
        raw_tick_sample,
        fred_observations,
        fred_observations_latest,
        finnhub_quotes,
        response_dead_letters,
        release_dead_letter_split,
        dry_run,
        market_bar_1m,
        market_bar_1h,
        market_bar_true_ohlc,
        macro_latest_state,
        enriched_market_macro_1m,
        enriched_proc_time,
        silver_market_bar_1m,
        silver_macro_release,
        market_daily,
        market_daily_multiyear,
        market_macro_aligned_daily,
        market_macro_aligned_daily_multiyear,
        market_macro_correlation_daily,
        market_macro_correlation_daily_multiyear,
        correlation_latest,
        avg_corr_by_symbol,
        table_row_counts,
        gold_refresh_incremental,
        monitor_recent_bars,
        monitor_recent_bars_stored,
        monitor_close_timeseries,
        serving_bar_minute,
        serving_bar_rollup,
        serving_late_reject,
        retention_keep,
        retention_keep_days,
        changelog_compact,
        curated_bar_events,
        state_events,
        enriched_events,
        market_bar_1m_stream,
        silver_market_bar_1m_stream,
        silver_macro_release_stream,
        macro_latest_state_stream,
        enriched_market_macro_1m_stream,
        serving_bar_minute_stream,
        dead_letter_split_stream,
        external_stream_scan,
        external_release_scan,
        retention_drop,
        late_tick_stream,
        restart_stream,
        segments_merged,
    )
}
