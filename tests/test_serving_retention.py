from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.builders import bars
from tests.conftest import utc
from tickmacro.operators import retention, serving
from tickmacro.plans import reports
from tickmacro.sources import tables
from tickmacro.schemas import BAR_TOPIC, RETENTION_DAYS, SILVER_BAR, STATE_TOPIC, TICK_TOPIC

NOW = utc("2024-03-31 12:00")


def test_serving_rows_are_per_bar_unless_rolled_up(spark):
    rows = bars(spark, ("G", NOW + timedelta(seconds=5), 1.0), ("G", NOW + timedelta(seconds=40), 2.0))
    plain = serving.serving_bars(rows).collect()
    assert {r["time"].second for r in plain} == {0} and len(plain) == 2
    rolled = serving.serving_bars(rows, rollup=True).first()
    assert [rolled[m] for m in serving.METRICS] == [3.0, 2, 2]
    assert serving.with_segment(serving.serving_bars(rows)).first()["hour"] == "2024-03-31-12"


def test_late_bars_are_refused(spark):
    rows = bars(spark, ("G", NOW - timedelta(hours=3), 1.0), ("G", NOW - timedelta(hours=1), 2.0))
    kept = serving.reject_late(rows, as_of=NOW)
    assert [r["close_price"] for r in kept.collect()] == [2.0]
    assert serving.reject_late(rows).count() == 0


def test_retention_keeps_recent_and_future_rows(spark):
    rows = bars(spark, *[("G", NOW + timedelta(days=d), float(d)) for d in (-31, -29, 1)])
    kept = retention.keep_recent(rows, "window_start", 30, NOW)
    assert {r["close_price"] for r in kept.collect()} == {-29.0, 1.0}


@pytest.mark.parametrize("days", [0, -1, 1.5, "30", True])
def test_retention_days_must_be_a_positive_integer(spark, days):
    with pytest.raises(ValueError):
        retention.keep_recent(bars(spark, ("G", NOW, 1.0)), "window_start", days)


def test_topic_retention_values():
    assert RETENTION_DAYS[TICK_TOPIC] == 7 and RETENTION_DAYS[STATE_TOPIC] is None


def _silver(spark, *rows):
    return spark.createDataFrame(
        [(at.date(), at, s, c, c, c, c, 1, 1) for s, at, c in rows], SILVER_BAR
    )


def test_expired_day_partitions_are_dropped(spark):
    days = [(NOW + timedelta(days=d)) for d in (-31, -30, 0, 2)]
    spark.sql("CREATE DATABASE IF NOT EXISTS retention_test")
    _silver(spark, *[("G", d, 1.0) for d in days]).write.mode("overwrite").partitionBy(
        "dt"
    ).saveAsTable("retention_test.bars")
    dropped = retention.drop_expired_partitions(
        spark, "retention_test.bars", 30, as_of=NOW.date()
    )
    assert dropped == [(NOW.date() - timedelta(days=31)).isoformat()]
    left = spark.table("retention_test.bars")
    assert {r["dt"] for r in left.collect()} == {d.date() for d in days[1:]}
    kept = retention.keep_recent_days(left, 30, NOW.date())
    assert kept.count() == 3
    assert retention.drop_expired_partitions(spark, "retention_test.bars", 30, NOW.date()) == []
    later = NOW.date() + timedelta(days=1)
    topics = {BAR_TOPIC: "retention_test.bars", STATE_TOPIC: "retention_test.none"}
    assert retention.apply_topic_retention(spark, topics, later) == {
        "retention_test.bars": [(NOW.date() - timedelta(days=30)).isoformat()]
    }
    spark.sql("DROP DATABASE retention_test CASCADE")


def test_recent_bars_by_day_are_the_same_bars(spark, tmp_path):
    rows = [(s, NOW - timedelta(hours=5 * h), float(h)) for h in range(40) for s in "AB"]
    path = str(tmp_path / "bars")
    _silver(spark, *rows).write.partitionBy("dt").parquet(path)
    stored = spark.read.schema(SILVER_BAR).parquet(path)
    for n in (1, 7, 50, 80, 500):
        assert (
            reports.recent_bars(stored, n, by_day=True).collect()
            == reports.recent_bars(stored, n).collect()
        )
    assert reports.recent_bars(stored.where(F.lit(False)), by_day=True).count() == 0


def test_close_timeseries_is_averaged_and_ordered(spark):
    at = NOW - timedelta(minutes=30)
    rows = _silver(spark, ("A", at, 1.0), ("A", at, 3.0), ("B", at, 5.0), ("A", NOW - timedelta(hours=2), 99.0))
    rows = rows.union(_silver(spark, ("A", NOW + timedelta(minutes=1), 77.0), ("A", NOW + timedelta(days=1), 88.0)))
    got = reports.close_timeseries(rows, as_of=NOW).collect()
    assert [(r["symbol"], r["avg_close_price"]) for r in got] == [("B", 5.0), ("A", 2.0)]


def test_rankings_put_undefined_last(spark):
    df = spark.createDataFrame(
        [("A", None, date(2024, 1, 1)), ("B", 0.1, date(2024, 1, 1)), ("C", 0.5, date(2024, 1, 1)), ("C", None, date(2024, 1, 2))],
        "symbol string, rolling_corr_30d double, dt date",
    )
    ranked = reports.avg_corr_by_symbol(df).collect()
    assert [(r[0], r[1]) for r in ranked] == [("C", 0.5), ("B", 0.1), ("A", None)]
    latest = reports.correlation_latest(df, "C", 1).collect()
    assert [r["dt"] for r in latest] == [date(2024, 1, 2)]


def test_expired_files_of_external_tables_go_as_well(spark, tmp_path):
    path = str(tmp_path / "bars")
    rows = _silver(spark, *[("G", NOW - timedelta(days=d), float(d)) for d in (0, 5, 40)])
    rows.write.partitionBy("dt").parquet(path)
    spark.sql("DROP TABLE IF EXISTS expiring_bars")
    tables.create_external_table(spark, "expiring_bars", SILVER_BAR, path)
    dropped = retention.drop_expired_partitions(spark, "expiring_bars", 30, NOW.date())
    assert dropped == [(NOW - timedelta(days=40)).date().isoformat()]
    tables.refresh_partitions(spark, "expiring_bars")
    assert spark.table("expiring_bars").count() == tables.silver_bars(spark, path).count() == 2
    spark.sql("DROP TABLE expiring_bars")


def test_retention_refuses_views(spark):
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW gold_view AS SELECT 1 AS x, current_date() AS dt")
    with pytest.raises(ValueError, match="view"):
        retention.drop_expired_partitions(spark, "gold_view", 30)


def test_the_late_bound_moves_by_the_hour(spark):
    rows = bars(spark, ("G", NOW - timedelta(hours=2), 1.0), ("G", NOW - timedelta(hours=2, minutes=1), 2.0))
    for minutes in (0, 59):
        kept = serving.reject_late(rows, as_of=NOW + timedelta(minutes=minutes))
        assert [r["close_price"] for r in kept.collect()] == [1.0]
