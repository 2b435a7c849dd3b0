from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.builders import silver_releases
from tests.conftest import utc
from tickmacro.operators.daily import align_daily, correlation_daily, market_daily, rolling_corr
from tickmacro.schemas import SILVER_BAR

DAY = date(2024, 1, 10)
DAILY = "dt date, symbol string, close_price double, volume bigint, tick_count bigint"
ALIGNED = (
    "symbol string, close_price double, volume bigint, tick_count bigint, macro_value double, "
    "macro_release_ts_utc timestamp, dt date"
)


def _daily(spark, *days, symbol="G"):
    return spark.createDataFrame([(d, symbol, 1.0, 1, 1) for d in days], DAILY)


def _values(df):
    return {r["dt"]: r["macro_value"] for r in df.collect()}


def test_daily_close_is_the_last_bar(spark):
    rows = [
        (DAY, utc(f"2024-01-10 {clock}"), "G", 0.0, 0.0, 0.0, close, 2, 3)
        for clock, close in (("09:00", 5.0), ("15:00", 6.0), ("12:00", 9.0))
    ]
    got = market_daily(spark.createDataFrame(rows, SILVER_BAR)).first()
    assert (got["close_price"], got["volume"], got["tick_count"]) == (6.0, 6, 9)


def test_a_release_counts_for_its_whole_day(spark):
    feed = silver_releases(
        spark,
        ("DFF", utc("2024-01-09 08:00"), DAY, 1.0),
        ("DFF", utc("2024-01-10 23:59:59.999"), DAY, 2.0),
        ("DFF", utc("2024-01-11 00:00"), DAY, 3.0),
        ("OTHER", utc("2024-01-10 12:00"), DAY, 9.0),
    )
    days = [DAY + timedelta(n) for n in (-2, -1, 0, 1, 40)]
    got = _values(align_daily(_daily(spark, *days), feed))
    assert [got[d] for d in days] == [None, 1.0, 2.0, 3.0, 3.0]


def test_days_without_any_release_are_kept(spark):
    feed = silver_releases(spark, ("OTHER", utc("2024-01-01"), DAY, 1.0))
    assert _values(align_daily(_daily(spark, DAY), feed)) == {DAY: None}


def test_releases_after_the_last_day_do_not_show(spark):
    feed = silver_releases(
        spark,
        ("DFF", utc("2024-01-01"), DAY, 1.0),
        ("DFF", utc("2025-01-01"), DAY, 2.0),
    )
    assert _values(align_daily(_daily(spark, DAY), feed)) == {DAY: 1.0}


def test_ties_go_to_the_newest_observation(spark):
    feed = silver_releases(
        spark,
        ("DFF", utc("2024-01-10"), date(2024, 1, 8), 7.0),
        ("DFF", utc("2024-01-10"), date(2024, 1, 9), 2.0),
    )
    assert _values(align_daily(_daily(spark, DAY), feed)) == {DAY: 2.0}


def test_a_null_value_at_the_newest_release_stays_null(spark):
    feed = silver_releases(
        spark,
        ("DFF", utc("2024-01-09"), DAY, 7.0),
        ("DFF", utc("2024-01-10"), DAY, None),
    )
    row = align_daily(_daily(spark, DAY), feed).first()
    assert row["macro_value"] is None and row["macro_release_ts_utc"].day == 10


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    released=st.lists(st.tuples(st.integers(-60, 60), st.integers(0, 23)), max_size=12, unique=True),
    days=st.lists(st.integers(-70, 90), min_size=1, max_size=12, unique=True),
)
def test_alignment_equals_a_scan(spark, released, days):
    start = utc("2024-03-01")
    instants = [(start + timedelta(days=d, hours=h), float(i)) for i, (d, h) in enumerate(released)]
    feed = silver_releases(spark, *[("DFF", at, at.date(), v) for at, v in instants])
    asked = [start.date() + timedelta(d) for d in days]
    got = _values(align_daily(_daily(spark, *asked), feed))
    assert len(got) == len(asked)
    for day in asked:
        known = [(at, v) for at, v in instants if at.date() <= day]
        assert got[day] == (max(known)[1] if known else None)


def _aligned(spark, pairs, symbol="G", gap=1):
    rows = [
        (symbol, x, 1, 1, y, None, DAY + timedelta(days=i * gap)) for i, (x, y) in enumerate(pairs)
    ]
    return spark.createDataFrame(rows, ALIGNED)


def _corr(spark, pairs, **kw):
    rows = correlation_daily(_aligned(spark, pairs, **kw)).orderBy("dt").collect()
    return [r["rolling_corr_30d"] for r in rows]


@pytest.mark.parametrize(
    "pairs",
    [
        [(1.0, 2.0)],
        [(float(i), 5.33) for i in range(40)],
        [(0.1, float(i)) for i in range(40)],
        [(float(i), None) for i in range(5)],
        [(None, None)] * 3,
    ],
)
def test_undefined_correlation_is_null(spark, pairs):
    assert set(_corr(spark, pairs)) == {None}


@pytest.mark.parametrize("gap", [1, 2])
def test_correlation_uses_the_last_30_rows(spark, gap):
    rng = np.random.default_rng(1)
    pairs = [(float(a), float(b)) for a, b in rng.normal(100, 5, (75, 2))]
    got = _corr(spark, pairs, gap=gap)
    assert got[0] is None
    for i in range(1, len(pairs)):
        x, y = np.array(pairs[max(0, i - 29) : i + 1]).T
        assert got[i] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-12)
    assert max(abs(c) for c in got[1:]) <= 1 + 1e-12


def test_incomplete_pairs_count_on_neither_side(spark):
    pairs = [(1.0, 1.0), (50.0, None), (2.0, 3.0), (None, 9.0), (3.0, 2.0)]
    want = np.corrcoef([1, 2, 3], [1, 3, 2])[0, 1]
    assert _corr(spark, pairs)[-1] == pytest.approx(want)


def test_calendar_days_are_an_option(spark):
    pairs = [(float(i * i), float(i % 5)) for i in range(20)]
    df = _aligned(spark, pairs, gap=10)
    rows = rolling_corr(
        df, "close_price", "macro_value", by="symbol", order="dt", days=30, name="c"
    )
    got = [r["c"] for r in rows.orderBy("dt").collect()]
    x, y = np.array(pairs[-3:]).T
    assert got[-1] == pytest.approx(np.corrcoef(x, y)[0, 1])
