from __future__ import annotations

import random
import shutil
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.builders import silver_releases
from tests.conftest import utc
from tickmacro.files import data_files
from tickmacro.operators.daily import align_daily, correlation_daily, market_daily
from tickmacro.plans import gold, reports
from tickmacro.schemas import ALIGNED_DAILY, CORRELATION_DAILY, SILVER_BAR, SILVER_RELEASE
from tickmacro.sources import tables


def _bar(day: int, close: float, symbol: str = "G"):
    at = utc(f"2024-01-{day:02d} 10:00")
    return (at.date(), at, symbol, close, close, close, close, 1, 1)


@pytest.fixture
def silver(spark, tmp_path):
    paths = {"bars_path": str(tmp_path / "bars"), "releases_path": str(tmp_path / "releases")}
    bars = spark.createDataFrame([_bar(d, float(d * d)) for d in range(1, 6)], SILVER_BAR)
    bars.write.partitionBy("dt").parquet(paths["bars_path"])
    feed = silver_releases(
        spark, *[("DFF", utc(f"2024-01-{d:02d}"), date(2024, 1, d), float(d)) for d in (2, 4)]
    )
    feed.write.partitionBy("dt").parquet(paths["releases_path"])
    return paths


@pytest.fixture
def database(spark):
    name = "gold_test"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def _names(df):
    return set(df.schema.fieldNames())


def test_refresh_builds_all_tables(spark, tmp_path, silver, database):
    built = gold.refresh_gold(spark, database=database, location=str(tmp_path / "db"), **silver)
    counts = dict(reports.row_counts(built).collect())
    assert counts == {
        "market_bar_1m": 5,
        "macro_release": 2,
        "market_macro_aligned_daily": 5,
        "market_macro_correlation_daily": 5,
    }
    assert list(counts) == gold.GOLD_TABLES
    for name, schema in zip(
        gold.GOLD_TABLES, (SILVER_BAR, SILVER_RELEASE, ALIGNED_DAILY, CORRELATION_DAILY)
    ):
        table = spark.table(f"{database}.{name}")
        assert {f.name: f.dataType for f in table.schema} == {f.name: f.dataType for f in schema}
    aligned = built[gold.ALIGNED].orderBy("dt").select("macro_value").collect()
    assert [r[0] for r in aligned] == [None, 2.0, 2.0, 4.0, 4.0]


def test_a_refresh_replaces_and_old_versions_go(spark, tmp_path, silver, database):
    where = {"database": database, "location": str(tmp_path / "db"), **silver}
    gold.refresh_gold(spark, **where)
    late = spark.createDataFrame([_bar(6, 36.0)], SILVER_BAR)
    late.write.mode("append").partitionBy("dt").parquet(silver["bars_path"])
    for _ in range(2):
        built = gold.refresh_gold(spark, **where)
    assert built[gold.CORRELATION].count() == 6
    versions = spark.sql(f"SHOW TABLES IN {database} LIKE '{gold.BARS}__v*'")
    assert versions.count() == 2


def test_a_day_filter_reads_one_folder(spark, tmp_path, silver, database):
    built = gold.refresh_gold(spark, database=database, location=str(tmp_path / "db"), **silver)
    one = built[gold.ALIGNED].where(F.col("dt") == date(2024, 1, 3))
    assert len(one.inputFiles()) >= 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_external_table_follows_its_files(spark, silver, database):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    name = f"{database}.bars"
    tables.create_external_table(spark, name, SILVER_BAR, silver["bars_path"])
    assert spark.table(name).count() == 5
    spark.createDataFrame([_bar(7, 1.0)], SILVER_BAR).write.mode("append").partitionBy(
        "dt"
    ).parquet(silver["bars_path"])
    tables.refresh_partitions(spark, name)
    assert spark.table(name).count() == 6
    spark.sql(f"DROP TABLE {name}")
    assert tables.silver_bars(spark, silver["bars_path"]).count() == 6


def _same(left, right):
    columns = right.columns
    assert left.select(*columns).exceptAll(right).isEmpty() and right.exceptAll(left.select(*columns)).isEmpty()


def test_incremental_refreshes_equal_full_ones(spark, tmp_path, database):
    """Late bars and releases, new days, removed days and files, call by call."""
    rng, start = random.Random(2), date(2024, 1, 1)
    paths = {"bars_path": str(tmp_path / "bars"), "releases_path": str(tmp_path / "releases")}
    where = {"database": database, "location": str(tmp_path / "db"), **paths}

    def add_bars(days):
        rows = []
        for n in days:
            day = start + timedelta(days=n)
            at = utc(f"{day} 10:00") + timedelta(minutes=rng.randrange(600))
            rows += [(day, at, s, *[rng.random()] * 4, 1, 1) for s in "AB" if rng.random() < 0.9]
        spark.createDataFrame(rows, SILVER_BAR).write.mode("append").partitionBy("dt").parquet(paths["bars_path"])

    def add_releases(days):
        rows = [("DFF" if n % 3 else "CPI", utc(f"{start + timedelta(days=n)} 09:00"), start, rng.random()) for n in days]
        silver_releases(spark, *rows).write.mode("append").partitionBy("dt").parquet(paths["releases_path"])

    def check():
        built = gold.refresh_gold_incremental(spark, **where)
        bars, releases = tables.silver_bars(spark, paths["bars_path"]), tables.silver_releases(spark, paths["releases_path"])
        _same(built[gold.BARS], bars)
        _same(built[gold.RELEASES], releases)
        aligned = align_daily(market_daily(bars), releases)
        _same(built[gold.ALIGNED], aligned)
        rounded = lambda df: df.withColumn("rolling_corr_30d", F.round("rolling_corr_30d", 9))
        _same(rounded(built[gold.CORRELATION]), rounded(correlation_daily(aligned)))
        return {name: data_files(spark, f"{tmp_path}/db/{name}") for name in gold.GOLD_TABLES}

    add_bars(range(40)), add_releases([4, 10, 20, 31])
    first = check()
    assert check() == first
    add_bars([12])
    late_bar = check()
    assert [k for k in first[gold.ALIGNED] if late_bar[gold.ALIGNED].get(k) != first[gold.ALIGNED][k]][0].startswith("dt=2024-01-13")
    add_releases([25])
    check()
    add_bars([41, 42, 44]), add_releases([43, 2])
    check()
    shutil.rmtree(tmp_path / "bars" / "dt=2024-01-16")
    shutil.rmtree(tmp_path / "releases" / "dt=2024-01-11")
    last = check()
    assert not any("2024-01-16" in k for name in (gold.BARS, gold.ALIGNED, gold.CORRELATION) for k in last[name])
    add_bars([15])
    check()
