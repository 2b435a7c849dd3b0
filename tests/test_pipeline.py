"""The whole way: events in, dead letters out, bars, silver, gold, reports."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.builders import Drop, encode
from tests.conftest import ms
from tickmacro.functions.envelopes import encode_events, market_envelope
from tickmacro.operators.serving import read_serving
from tickmacro.plans import gold, reports
from tickmacro.schemas import RELEASE_EVENT, TICK_DEAD_TOPIC, TICK_EVENT, TICK_TOPIC
from tickmacro.sources import tables
from tickmacro.sources.events import decode_releases, decode_ticks, route_dead_letters
from tickmacro.streaming import enrichment, jobs

ONCE = {"availableNow": True}
SYMBOLS = ["GOOG", "MSFT"]
DAYS = 4


@pytest.fixture
def root(tmp_path, spark):
    yield tmp_path
    spark.sql("DROP DATABASE IF EXISTS pipeline_test CASCADE")


def _tick_lines(spark):
    """Ticks every half hour for some days, two of them spoilt."""
    start = ms("2024-01-01")
    rows = [(s, 180.0 + n % 7, 1 + n % 5, start + n * 1_800_000) for s in SYMBOLS for n in range(48 * DAYS)]
    ticks = spark.createDataFrame(rows, "symbol string, price double, size long, event_ts_ms long")
    envelope = market_envelope(
        "test",
        symbol=F.col("symbol"),
        price=F.col("price"),
        size=F.col("size"),
        event_ts_ms=F.col("event_ts_ms"),
    )
    lines = [r["value"] for r in encode_events(ticks, envelope, TICK_TOPIC).collect()]
    return lines + ["{", '{"payload": 1}']


def _release_lines(spark):
    rows = []
    for n, day in enumerate(range(DAYS, 0, -1)):
        text = f"2024-01-{day:02d}"
        at = ms(text)
        rows.append((str(n), "t", "DFF", at, n, "v1", ("DFF", text, 5.0 + day % 2, at, text, text)))
    return encode(spark, RELEASE_EVENT, rows)


def test_pipeline(spark, root):
    landing, releases_in = Drop(root / "ticks-in"), Drop(root / "releases-in")
    landing.add(_tick_lines(spark))
    landing.add(encode(spark, TICK_EVENT, [("z", "t", "Z", ms("2024-02-01"), 0, "v1", ("Z", 1.0, 1))]))
    releases_in.add(_release_lines(spark))

    def run(query):
        query.awaitTermination()

    routed = route_dead_letters(
        landing.stream(spark).withColumn("key", F.lit(None).cast("string")),
        TICK_EVENT,
        topic=TICK_TOPIC,
        dead_topic=TICK_DEAD_TOPIC,
    )
    run(jobs.start_routed(routed, f"{root}/events", f"{root}/run/events", trigger=ONCE))
    events = jobs.read_routed(spark, f"{root}/events")
    assert events.where(F.col("topic") == TICK_DEAD_TOPIC).count() == 2

    live = spark.readStream.schema(events.schema).parquet(f"{root}/events")
    ticks = decode_ticks(live.where(F.col("topic") == TICK_TOPIC))
    run(jobs.start_bars(ticks, f"{root}/bars", f"{root}/run/bars", trigger=ONCE))
    assert tables.read_bars(spark, f"{root}/bars").count() == 48 * DAYS * len(SYMBOLS)

    def bar_stream():
        return tables.read_bars(spark, f"{root}/bars", streaming=True)

    def release_stream():
        return decode_releases(releases_in.stream(spark))

    run(jobs.start_silver_bars(bar_stream(), f"{root}/silver/bars", f"{root}/run/sb", trigger=ONCE))
    run(
        jobs.start_silver_releases(
            release_stream(), f"{root}/silver/releases", f"{root}/run/sr", trigger=ONCE
        )
    )
    run(
        jobs.start_macro_state(
            release_stream(), f"{root}/state", f"{root}/run/st", arrival="ingest_ts_ms", trigger=ONCE
        )
    )
    # The feed came newest first, so its oldest release is the state.
    state = jobs.read_macro_state(spark, f"{root}/state").collect()
    assert [tuple(r) for r in state] == [("DFF", 6.0, ms("2024-01-01"))]

    run(
        enrichment.start_enrichment(
            bar_stream(),
            release_stream(),
            f"{root}/enriched",
            f"{root}/run/en",
            arrival=F.col("ingest_ts_ms"),
            trigger=ONCE,
        )
    )
    enriched = enrichment.read_enriched(spark, f"{root}/enriched")
    ages = enriched.where("symbol = 'GOOG'").agg(F.min("macro_age_minutes"), F.max("macro_age_minutes"))
    assert tuple(ages.first()) == (0, 24 * 60 * DAYS - 30)
    assert enriched.count() == 48 * DAYS * len(SYMBOLS)

    run(
        jobs.start_serving(
            bar_stream(), f"{root}/serving", f"{root}/run/se", late_after=None, trigger=ONCE
        )
    )
    assert read_serving(spark, f"{root}/serving").where("hour = '2024-01-02-00'").count() == 4

    built = gold.refresh_gold(
        spark,
        bars_path=f"{root}/silver/bars",
        releases_path=f"{root}/silver/releases",
        database="pipeline_test",
        location=f"{root}/gold",
    )
    aligned = built[gold.ALIGNED].where("symbol = 'GOOG'").orderBy("dt").collect()
    assert [(r["dt"], r["macro_value"], r["tick_count"]) for r in aligned] == [
        (date(2024, 1, day), 5.0 + day % 2, 48) for day in range(1, DAYS + 1)
    ]
    latest = reports.correlation_latest(built[gold.CORRELATION], "GOOG").collect()
    assert [r["dt"].day for r in latest] == [4, 3, 2, 1] and latest[-1]["rolling_corr_30d"] is None
    assert {r["symbol"] for r in reports.avg_corr_by_symbol(built[gold.CORRELATION]).collect()} == set(SYMBOLS)
    recent = reports.recent_bars(built[gold.BARS], 3, by_day=True).collect()
    assert {r["bucket_1m_utc"].day for r in recent} == {DAYS}
