from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.builders import bars, releases, ticks
from tests.conftest import ms, utc
from tickmacro.operators.bars import build_bars
from tickmacro.operators.enrich import enrich
from tickmacro.operators.state import latest_by_key, latest_state

PRICES = ["open_price", "high_price", "low_price", "close_price", "volume", "tick_count"]


def _one_minute(spark):
    return ticks(
        spark, ("G", 10.0, 1, 1_000), ("G", 12.0, 2, 30_000), ("G", 11.0, 3, 59_000)
    )


def test_open_is_the_low_and_close_the_high(spark):
    row = build_bars(_one_minute(spark)).select(PRICES).collect()
    assert [tuple(r) for r in row] == [(10.0, 12.0, 10.0, 12.0, 6, 3)]


def test_event_time_open_and_close(spark):
    row = build_bars(_one_minute(spark), ohlc="event_time").select(PRICES).collect()
    assert [tuple(r) for r in row] == [(10.0, 12.0, 10.0, 11.0, 6, 3)]


def test_event_time_ties_go_by_event_id(spark):
    tied = ticks(spark, ("G", 5.0, 1, 1_000), ("G", 4.0, 1, 1_000), ("G", 6.0, 1, 1_000))
    row = build_bars(tied, ohlc="event_time").first()
    assert (row["open_price"], row["close_price"]) == (5.0, 6.0)


def test_unknown_ohlc_is_refused(spark):
    with pytest.raises(ValueError):
        build_bars(_one_minute(spark), ohlc="other")


def test_windows_are_half_open(spark):
    rows = build_bars(ticks(spark, ("G", 1.0, 1, 59_999), ("G", 2.0, 1, 60_000)))
    got = rows.orderBy("window_start").select("window_start", "window_end", "close_price")
    assert [(r[0].minute, r[1].minute, r[2]) for r in got.collect()] == [(0, 1, 1.0), (1, 2, 2.0)]


def test_input_order_does_not_matter_and_ticks_are_conserved(spark):
    rows = [("AB"[i % 2], float(i * 7 % 13), i, i * 997) for i in range(400)]
    forth = build_bars(ticks(spark, *rows))
    back = build_bars(ticks(spark, *rows[::-1]))
    assert forth.exceptAll(back).count() == 0
    totals = forth.agg(F.sum("tick_count"), F.sum("volume")).first()
    assert tuple(totals) == (400, sum(range(400)))
    inside = (F.col("low_price") <= F.col("open_price")) & (F.col("close_price") <= F.col("high_price"))
    assert forth.where(~inside).count() == 0


def test_latest_state_is_the_last_arrival(spark):
    """Releases come newest first, so the oldest of them stays."""
    feed = releases(spark, ("DFF", 3.0, 300, 1), ("DFF", 2.0, 200, 2), ("DFF", 1.0, 100, 3))
    order = F.col("event_id").cast("bigint")
    assert tuple(latest_state(feed, arrival=order).first()) == ("DFF", 1.0, 100)
    newest = latest_state(feed, by="release_ts", arrival=order).first()
    assert tuple(newest) == ("DFF", 3.0, 300)
    with pytest.raises(ValueError):
        latest_state(feed, by="other")


def test_latest_state_keeps_a_null_value(spark):
    feed = releases(spark, ("DFF", 3.0, 300, 1), ("DFF", None, 200, 2))
    assert latest_state(feed, arrival="ingest_ts_ms").first()["macro_value"] is None


def test_latest_by_key_takes_all_columns_from_one_row(spark):
    rows = spark.range(10_000).select(
        (F.col("id") % 3).alias("k"),
        F.lit(7).alias("version"),
        F.col("id").alias("a"),
        (F.col("id") * 2).alias("b"),
    )
    for row in latest_by_key(rows, ["k"], "version").collect():
        assert row["b"] == row["a"] * 2


def test_age_is_cut_toward_zero(spark):
    at = utc("2024-01-01 10:00:00")
    feed = releases(spark, ("DFF", 1.0, ms("2024-01-01 12:00:30"), 1))
    state = latest_state(feed, arrival="ingest_ts_ms")
    row = enrich(bars(spark, ("G", at, 5.0)), state).first()
    assert row["macro_age_minutes"] == -120
    assert (row["series_id"], row["macro_value"], row["close_price"]) == ("DFF", 1.0, 5.0)


def test_no_bar_comes_out_without_a_value(spark):
    state = latest_state(releases(spark, ("OTHER", 1.0, 0, 1)), arrival="ingest_ts_ms")
    assert enrich(bars(spark, ("G", utc("2024-01-01"), 5.0)), state).count() == 0


def test_two_states_of_a_series_are_an_error(spark):
    state = spark.createDataFrame(
        [("DFF", 1.0, 1), ("DFF", 2.0, 2)],
        "series_id string, macro_value double, release_ts_ms bigint",
    )
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        enrich(bars(spark, ("G", utc("2024-01-01"), 5.0)), state).collect()


def test_processing_time_is_an_extra_column(spark):
    state = latest_state(releases(spark, ("DFF", 1.0, 0, 1)), arrival="ingest_ts_ms")
    row = enrich(bars(spark, ("G", utc("2024-01-01"), 5.0)), state, proc_time=True).first()
    assert row["proc_time"] > utc("2024-01-01").replace(tzinfo=None)
