"""The shape of the physical plans: what is scanned, shuffled and broadcast."""

from __future__ import annotations

import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tickmacro.checks import queries, tables as given
from tickmacro.operators import bars, daily, silver
from tickmacro.plans import reports
from tickmacro.schemas import SILVER_BAR
from tickmacro.sources import responses


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single)", plan))


def test_bars_take_one_shuffle_after_a_partial_aggregate(spark, sf_dir):
    plan = _plan(queries.market_bar_1m(spark, sf_dir))
    assert _exchanges(plan) == 1
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    assert "Filter (event_type" not in plan
    assert re.search(r"ReadSchema: struct<ts:\S+,event_type:string,value:double,props:string>", plan)


def test_daily_close_reads_only_what_it_needs(spark, sf_dir):
    df = daily.correlation_daily(
        daily.align_daily(
            daily.market_daily(silver.silver_bars(bars.build_bars(given.event_ticks(given.read_table(spark, sf_dir, "events"))))),
            silver.silver_releases(given.event_releases(given.read_table(spark, sf_dir, "events"))),
            given.EVENT_SERIES,
        )
    )
    plan = _plan(df)
    assert "props" not in plan and "user_id" not in plan


def test_alignment_has_no_nested_loop_and_broadcasts_by_size(spark, sf_dir):
    plan = _plan(queries.market_macro_aligned_daily(spark, sf_dir))
    assert "BroadcastHashJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = queries.market_macro_aligned_daily(spark, sf_dir)
        assert "SortMergeJoin" in _plan(large)
        merged = large.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    small = queries.market_macro_aligned_daily(spark, sf_dir).collect()
    assert sorted(map(str, merged)) == sorted(map(str, small))


def test_enrichment_does_not_join(spark, sf_dir):
    plan = _plan(queries.enriched_market_macro_1m(spark, sf_dir))
    assert "Join" not in plan and "Broadcast" not in plan


def test_state_is_a_hash_aggregate(spark, sf_dir):
    plan = _plan(queries.macro_latest_state(spark, sf_dir))
    assert "SortAggregate" not in plan and "partial_max_by" in plan


def test_newest_observations_are_trimmed_before_the_shuffle(spark, sf_dir):
    plan = _plan(queries.fred_observations_latest(spark, sf_dir))
    assert plan.count("WindowGroupLimit") == 4 and plan.count(", Partial") == 2


def test_top_reports_do_not_sort_everything(spark, sf_dir):
    for query in (queries.monitor_recent_bars, queries.raw_tick_sample):
        assert "TakeOrderedAndProject" in _plan(query(spark, sf_dir))


@pytest.fixture
def stored(spark, tmp_path, sf_dir):
    path = str(tmp_path / "bars")
    queries._silver_bars(spark, sf_dir).write.partitionBy("dt").parquet(path)
    return spark.read.schema(SILVER_BAR).parquet(path)


def test_reports_prune_days(spark, stored):
    at = datetime(2024, 1, 30, 12, tzinfo=timezone.utc)
    plan = _plan(reports.close_timeseries(stored, as_of=at))
    assert re.search(r"PartitionFilters: \[isnotnull\(dt\S+, \(dt", plan)
    assert "dynamicpruning" not in plan
    newest = reports.recent_bars(stored, by_day=True)
    assert re.search(r"PartitionFilters: \[isnotnull\(dt\S+, \(dt\S+ >= ", _plan(newest))
    newest.collect()


def test_symbol_filter_reaches_the_scan(spark, tmp_path, sf_dir):
    path = str(tmp_path / "corr")
    queries.market_macro_correlation_daily(spark, sf_dir).write.partitionBy("dt").parquet(path)
    plan = _plan(reports.correlation_latest(spark.read.parquet(path), "click"))
    assert "EqualTo(symbol,click)" in plan and "TakeOrderedAndProject" in plan


def test_large_limits_are_trimmed_as_well(spark):
    columns = ("series_id", "date", "value", "realtime_start", "realtime_end")
    df = spark.range(100_000).select(*[F.col("id").cast("string").alias(c) for c in columns])
    plan = _plan(responses.newest_observations(df, 5000))
    assert plan.count("WindowGroupLimit") == 4


def test_alignment_reads_releases_once_and_sorts_none(spark, sf_dir):
    from tickmacro.checks import tables as t
    from tickmacro.operators import daily, silver

    shipments = t.shipment_releases(t.read_table(spark, sf_dir, "lineitem"))
    releases = silver.silver_releases(shipments)
    days = _plan(daily.release_days(releases, t.ORDER_SERIES))
    assert "SortAggregate" not in days and days.count("Scan parquet") == 1
    market = daily.market_daily(silver.silver_bars(queries._bars(spark, sf_dir)))
    aligned = _plan(daily.align_daily(market, releases, t.ORDER_SERIES))
    assert "lineitem" not in aligned and "SortAggregate" not in aligned


def test_a_response_body_is_parsed_once(spark, sf_dir):
    for query in (queries.fred_observations, queries.fred_observations_latest, queries.finnhub_quotes):
        plan = query(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1
