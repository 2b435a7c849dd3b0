from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.builders import encode, tick_rows
from tickmacro.functions.envelopes import (
    dry_run_lines,
    encode_events,
    macro_envelope,
    market_envelope,
)
from tickmacro.schemas import RELEASE_EVENT, TICK_EVENT
from tickmacro.sources import events, responses
from tickmacro.streaming import jobs


def test_market_envelope_has_the_declared_fields(spark):
    envelope = market_envelope(
        "finnhub_mock",
        symbol=F.lit("GOOG"),
        price=F.lit(182.12341),
        size=F.lit(100).cast("bigint"),
        event_ts_ms=F.lit(1_700_000_000_000),
    )
    row = encode_events(spark.range(1), envelope, "ticks").first()
    event = json.loads(row["value"])
    assert (row["topic"], row["key"]) == ("ticks", "GOOG")
    assert list(event) == TICK_EVENT.fieldNames()
    assert event["source"] == "finnhub_mock"
    assert event["entity_key"] == "GOOG"
    assert event["event_ts_ms"] == 1_700_000_000_000
    assert event["schema_version"] == "v1"
    assert event["payload"] == {"symbol": "GOOG", "price": 182.1234, "size": 100}
    assert len(event["event_id"]) == 36 and event["ingest_ts_ms"] > 1_700_000_000_000


def test_macro_envelope_event_time_is_the_release_time(spark):
    envelope = macro_envelope(
        "fred_batch",
        series_id=F.lit("DFF"),
        observation_date=F.lit("2026-03-25"),
        value=F.lit(4.5),
        release_ts_ms=F.lit(1_700_000_000_000),
        realtime_start=F.lit("2026-03-25"),
        realtime_end=F.lit("2026-03-25"),
    )
    event = json.loads(encode_events(spark.range(1), envelope, "t").first()["value"])
    assert list(event) == RELEASE_EVENT.fieldNames()
    assert event["source"] == "fred_batch" and event["entity_key"] == "DFF"
    assert event["event_ts_ms"] == event["payload"]["release_ts_ms"] == 1_700_000_000_000
    assert event["payload"]["series_id"] == "DFF" and event["payload"]["value"] == 4.5


def test_a_sent_batch_is_read_back_per_topic(spark, tmp_path):
    envelope = market_envelope(
        "s", symbol=F.lit("A"), price=F.lit(1.0), size=F.lit(1), event_ts_ms=F.col("id")
    )
    sent = encode_events(spark.range(3), envelope, "ticks")
    jobs.send_events(sent, "json", str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out")).where("topic = 'ticks' and key = 'A'")
    assert events.decode_ticks(back).agg(F.sum("event_ts_ms")).first()[0] == 3
    jobs.send_events(sent, "console")


def test_a_dry_run_shows_topic_key_and_event(spark):
    envelope = market_envelope(
        "s", symbol=F.lit("A"), price=F.lit(1.0), size=F.lit(1), event_ts_ms=F.lit(5)
    )
    line = json.loads(dry_run_lines(spark.range(1), envelope, "ticks").first()["value"])
    assert (line["topic"], line["key"], line["event"]["event_ts_ms"]) == ("ticks", "A", 5)


def test_event_ids_differ(spark):
    envelope = market_envelope(
        "s", symbol=F.lit("A"), price=F.lit(1.0), size=F.lit(1), event_ts_ms=F.col("id")
    )
    ids = spark.range(100).select(envelope.alias("e")).select("e.event_id")
    assert ids.distinct().count() == 100


def test_decode_fails_on_malformed_events_unless_routed(spark):
    good = encode(spark, TICK_EVENT, tick_rows(("G", 1.5, 2, 1_000)))
    bad_type = '{"payload": {"symbol": "G", "price": "x", "size": 1}}'
    timeless = '{"event_id": "1", "payload": {"symbol": "G", "price": 1.0, "size": 1}}'
    lacking = ["{}", timeless, '{"event_id": "1", "event_ts_ms": 5}', '{"event_ts_ms": 5, "payload": {"symbol": "G", "price": 1.0}}']
    bad = ["{bad", bad_type, "", *lacking]
    raw = spark.createDataFrame([(v,) for v in [*good, *bad]], "value string")
    routed = events.route_dead_letters(raw, TICK_EVENT, topic="live", dead_topic="dead")
    assert dict(routed.groupBy("topic").count().collect()) == {"live": 1, "dead": len(bad)}
    dead = routed.where("topic = 'dead'").select("value")
    assert {r[0] for r in dead.collect()} == set(bad)
    with pytest.raises(Exception, match="without event_ts_ms"):
        events.decode_ticks(raw.where(F.col("value") == timeless)).collect()
    tick = events.decode_ticks(routed.where("topic = 'live'")).first()
    assert (tick["payload"]["price"], tick["event_time"].second) == (1.5, 1)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        events.decode_ticks(raw.where("value = '{bad'")).collect()


def test_drop_resent_keeps_one_copy_per_natural_key(spark):
    rows = tick_rows(("G", 1.0, 1, 1_000), ("G", 1.0, 1, 1_000), ("G", 1.0, 1, 2_000))
    df = spark.createDataFrame(rows, TICK_EVENT)
    assert events.drop_resent(df, ["entity_key", "event_ts_ms"]).count() == 2


def test_parse_series():
    assert responses.parse_series(" DFF, ,CPIAUCSL,,UNRATE ") == ["DFF", "CPIAUCSL", "UNRATE"]


def _landed(spark, observations, series="DFF"):
    body = json.dumps({"observations": observations})
    return spark.createDataFrame([(series, body)], "series_id string, body string")


def test_missing_observations_are_dropped_and_days_default(spark):
    landed = _landed(
        spark,
        [
            {"date": "2024-01-01", "value": "."},
            {"date": "2024-01-02"},
            {"date": "2024-01-03", "value": "4.33"},
            {"date": "2024-01-04", "value": "5", "realtime_start": "", "realtime_end": "2024-02-01"},
            {"date": "2024-01-05", "value": "6", "realtime_start": "2024-01-09"},
        ],
    )
    rows = responses.observations(responses.raw_observations(landed)).orderBy("observation_date")
    day = 86_400_000
    assert [tuple(r) for r in rows.collect()] == [
        ("DFF", "2024-01-03", 4.33, 19725 * day, "2024-01-03", "2024-01-03"),
        ("DFF", "2024-01-04", 5.0, 19726 * day, "", "2024-02-01"),
        ("DFF", "2024-01-05", 6.0, 19731 * day, "2024-01-09", "2024-01-05"),
    ]


def test_a_response_without_observations_gives_no_rows(spark):
    landed = spark.createDataFrame([("DFF", "{}")], "series_id string, body string")
    assert responses.raw_observations(landed).count() == 0


@pytest.mark.parametrize("limit", [3, 1500])
def test_newest_observations_counts_missing_ones(spark, limit):
    """The limit applies before missing values are dropped, as the service does."""
    days = spark.range(4000).select(
        F.lit("DFF").alias("series_id"),
        F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("date"),
        F.when(F.col("id") == 3998, ".").otherwise(F.col("id").cast("string")).alias("value"),
        F.lit(None).cast("string").alias("realtime_start"),
        F.lit(None).cast("string").alias("realtime_end"),
    )
    rows = responses.observations(responses.newest_observations(days, limit))
    want = {float(i) for i in range(4000 - limit, 4000)} - {3998.0}
    assert {r["value"] for r in rows.collect()} == want


def test_newest_observations_keeps_copies(spark):
    """Copies of one observation count one by one, with salts as without."""
    rows = [("S", "2024-01-01", "1", None, None)] * 3000
    schema = "series_id string, date string, value string, realtime_start string, realtime_end string"
    df = spark.createDataFrame(rows, schema).repartition(4)
    assert responses.newest_observations(df, 2000).count() == 2000


def test_quotes(spark):
    landed = spark.createDataFrame(
        [("GOOG", '{"c": 182.5, "t": 1700000000}'), ("A", '{"c": "7", "t": 1}')],
        "symbol string, body string",
    )
    assert [tuple(r) for r in responses.quotes(landed).collect()] == [
        ("GOOG", 182.5, 1_700_000_000_000, 1),
        ("A", 7.0, 1_000, 1),
    ]


def test_broken_responses_are_split_off_or_fail(spark):
    bodies = ['{"c": 1, "t": 2}', '{"c": 1', "<html>", '{"c": 1}', '{"t": 2}', "", None, '{"c": "x", "t": 2}']
    landed = spark.createDataFrame([("G", b) for b in bodies], "symbol string, body string")
    split = responses.split_quotes(landed)
    assert [r["body"] for r in split.where("not dead").collect()] == bodies[:1]
    assert split.where("dead").count() == len(bodies) - 1
    with pytest.raises(Exception, match="broken response"):
        responses.quotes(landed).collect()
    bodies = ['{"observations": [{"date": "2024-01-01", "value": "1"}]}', "{}", '{"observations": [{"date"', "<html>", '{"observations": [{"value": "1"}]}', None]
    landed = spark.createDataFrame([("S", b) for b in bodies], "series_id string, body string")
    split = responses.split_observations(landed)
    assert [r["body"] for r in split.where("not dead").collect()] == bodies[:2]
    assert responses.raw_observations(split.where("not dead")).count() == 1
    with pytest.raises(Exception, match="broken response"):
        responses.raw_observations(landed).collect()


def test_kafka_options_read_committed_records_from_the_start():
    options = events.kafka_options("broker:9092", "ticks")
    assert options["startingOffsets"] == "earliest"
    assert options["kafka.isolation.level"] == "read_committed"


def test_rows_pass_through_keyed_json(spark):
    from tests.builders import bars
    from tests.conftest import utc
    from tickmacro.functions.envelopes import decode_rows, encode_rows
    from tickmacro.schemas import BAR, BAR_TOPIC, TOPIC_KEYS

    rows = bars(spark, ("G", utc("2024-01-01 00:01"), 1.5), (None, utc("2024-01-01 00:02"), 2.0))
    sent = encode_rows(rows, BAR_TOPIC, TOPIC_KEYS[BAR_TOPIC])
    assert json.loads(sent.first()["key"]) == {"symbol": "G", "window_start": "2024-01-01 00:01:00.000"}
    assert set(json.loads(sent.collect()[1]["value"])) == set(BAR.fieldNames())
    assert sorted(decode_rows(sent, BAR).collect(), key=str) == sorted(rows.collect(), key=str)
    with pytest.raises(Exception, match="MALFORMED"):
        decode_rows(spark.createDataFrame([("{",)], "value string"), BAR).collect()
