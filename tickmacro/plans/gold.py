"""The gold refresh: silver files to managed, dated tables."""

from __future__ import annotations

import time
from bisect import bisect_right
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickmacro.files import children, data_files, delete, exists
from tickmacro.operators.daily import FRAME, align_daily, correlation_daily, market_daily
from tickmacro.operators.enrich import DEFAULT_SERIES
from tickmacro.operators.retention import expired_before
from tickmacro.schemas import ALIGNED_DAILY, CORRELATION_DAILY, SILVER_BAR, SILVER_RELEASE
from tickmacro.sources import tables

BARS, RELEASES = "market_bar_1m", "macro_release"
ALIGNED, CORRELATION = "market_macro_aligned_daily", "market_macro_correlation_daily"
GOLD_TABLES = [BARS, RELEASES, ALIGNED, CORRELATION]


def create_database(spark: SparkSession, database: str, location: str) -> None:
    """A namespace whose managed tables live under ``location``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")


def publish(
    df: DataFrame,
    database: str,
    name: str,
    *,
    partition_by: str = "dt",
    rebalance: bool = True,
    keep: int = 2,
) -> DataFrame:
    """Replace a table by ``df`` without a moment in which it is missing.

    Each refresh writes its own table, then the view ``name`` is pointed at it.
    The last ``keep`` versions stay, for readers that began before the swap.

    ``rebalance`` gathers a day into few files and splits a large day over
    several; leave it off where the input files are dated already.
    """
    spark = df.sparkSession
    # Fixed width, so that name order is time order.
    version = f"{database}.{name}__v{time.time_ns():020d}"
    rows = df.hint("rebalance", partition_by) if rebalance else df
    rows.write.mode("errorifexists").format("parquet").partitionBy(partition_by).saveAsTable(
        version
    )
    columns = ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {columns} FROM {version}")
    found = spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__v*'").select("tableName")
    versions = sorted(row["tableName"] for row in found.toLocalIterator())
    for old in versions[:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{old}")
    return spark.table(f"{database}.{name}")


def refresh_gold(
    spark: SparkSession,
    *,
    bars_path: str,
    releases_path: str,
    database: str,
    location: str,
    series_id: str = DEFAULT_SERIES,
) -> dict[str, DataFrame]:
    """Rebuild all gold tables from silver files.

    The later tables read the tables written before them, so a lost executor
    costs a part of one step, not the chain. The mirrors copy dated files and
    need no shuffle.
    """
    create_database(spark, database, location)
    bars = publish(tables.silver_bars(spark, bars_path), database, BARS, rebalance=False)
    releases = publish(
        tables.silver_releases(spark, releases_path), database, RELEASES, rebalance=False
    )
    aligned = publish(align_daily(market_daily(bars), releases, series_id), database, ALIGNED)
    correlation = publish(correlation_daily(aligned), database, CORRELATION)
    return {BARS: bars, RELEASES: releases, ALIGNED: aligned, CORRELATION: correlation}


# Incremental refresh: the same tables, each in one folder of its own whose days are
# overwritten as their input changes. It is asked for, never chosen by size.

_MANIFEST, _DAY = "_refresh", "dt"
_FILES = "kind string, day string, name string, length bigint, modified bigint"


def refresh_gold_incremental(
    spark: SparkSession,
    *,
    bars_path: str,
    releases_path: str,
    database: str,
    location: str,
    series_id: str = DEFAULT_SERIES,
) -> dict[str, DataFrame]:
    """Bring the gold tables up to date with the silver files that changed since the
    last call; the first call builds all. The result equals a full refresh.

    A list of the silver files, kept beside the tables, tells which days changed. A
    changed day of bars is aligned anew; a changed day of releases bears on the market
    days from it to the next release day; a day aligned anew bears on the 29 rows of
    each symbol after it. Folders of other days keep their files. The list is written
    last, so a call that broke off is simply made again. Readers of a day that is being
    replaced may have to read again: unlike ``refresh_gold`` there are no versions. A
    database has the tables of one of the two. Lists of files and days pass the driver.
    Rows without a day are in no folder of a day and left out.
    """
    create_database(spark, database, location)
    manifest = f"{location}/{_MANIFEST}"
    done = [n for n in children(spark, manifest) if exists(spark, f"{manifest}/{n}/_SUCCESS")]
    before = _listed(spark, f"{manifest}/{done[-1]}") if done else {}
    after = {BARS: _days(spark, bars_path), RELEASES: _days(spark, releases_path)}
    changed, gone = {}, {}
    for kind, days in after.items():
        old = before.get(kind, {})
        changed[kind] = sorted(d for d in days if old.get(d) != days[d])
        gone[kind] = sorted(set(old) - set(days))

    folder = {name: f"{location}/{name}" for name in GOLD_TABLES}
    bars, releases = tables.silver_bars(spark, bars_path), tables.silver_releases(spark, releases_path)
    _overwrite(_of_days(bars, changed[BARS]), folder[BARS], changed[BARS], rebalance=False)
    _overwrite(_of_days(releases, changed[RELEASES]), folder[RELEASES], changed[RELEASES], rebalance=False)
    _drop_days(spark, folder[BARS], gone[BARS])
    _drop_days(spark, folder[RELEASES], gone[RELEASES])
    bars = _stored(spark, folder[BARS], SILVER_BAR)
    releases = _stored(spark, folder[RELEASES], SILVER_RELEASE)

    market_days = sorted(after[BARS])
    news = sorted({*changed[RELEASES], *gone[RELEASES]})
    known = releases.where(F.col("series_id") == series_id).select(F.col(_DAY).cast("string")).distinct()
    known = sorted(r[0] for r in known.toLocalIterator())
    days = sorted({*changed[BARS], *_from_release_on(news, sorted(set(known) - set(news)), market_days)})
    if days:
        # Older releases than the newest before the first of these days bear on none of them.
        first = bisect_right(known, days[0]) - 1
        relevant = releases.where(F.col(_DAY) >= F.lit(known[first]).cast("date")) if first >= 0 else releases
        fresh = align_daily(market_daily(_of_days(bars, days)), relevant, series_id)
        _overwrite(fresh, folder[ALIGNED], days)
    _drop_days(spark, folder[ALIGNED], gone[BARS])

    aligned = _stored(spark, folder[ALIGNED], ALIGNED_DAILY)
    touched = sorted({*days, *gone[BARS]})
    if touched and market_days:
        fresh, days = _correlation_after(aligned, touched, market_days)
        _overwrite(fresh, folder[CORRELATION], days)
    _drop_days(spark, folder[CORRELATION], gone[BARS])

    out = {}
    for name, schema in zip(GOLD_TABLES, (SILVER_BAR, SILVER_RELEASE, ALIGNED_DAILY, CORRELATION_DAILY)):
        table = f"{database}.{name}"
        tables.create_external_table(spark, table, schema, folder[name])
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
            day = row["partition"].split("=", 1)[1]
            if not exists(spark, f"{folder[name]}/{_DAY}={day}"):
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_DAY} = '{day}')")
        spark.catalog.refreshTable(table)
        out[name] = spark.table(table).select(*schema.fieldNames())
    rows = [(k, d, n, *s) for k, listed in after.items() for d, found in listed.items() for n, s in found.items()]
    number = int(done[-1]) + 1 if done else 0
    spark.createDataFrame(rows, _FILES).coalesce(1).write.mode("overwrite").parquet(f"{manifest}/{number:010d}")
    for old in done[:-1]:
        delete(spark, f"{manifest}/{old}")
    return out


def _days(spark: SparkSession, path: str) -> dict[str, dict[str, tuple[int, int]]]:
    """The files of each day of a silver folder, without expired days."""
    out: dict[str, dict] = defaultdict(dict)
    bound = expired_before(spark, path) or ""
    for name, state in data_files(spark, path).items():
        day = name.split("/", 1)[0].removeprefix(f"{_DAY}=")
        if len(day) == 10 and day >= bound:
            out[day][name] = state
    return dict(out)


def _listed(spark: SparkSession, path: str) -> dict[str, dict[str, dict[str, tuple[int, int]]]]:
    out: dict[str, dict] = defaultdict(lambda: defaultdict(dict))
    for r in spark.read.schema(_FILES).parquet(path).toLocalIterator():
        out[r["kind"]][r["day"]][r["name"]] = (r["length"], r["modified"])
    return {kind: dict(days) for kind, days in out.items()}


def _stored(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder).select(*schema.fieldNames())


def _of_days(rows: DataFrame, days: list[str]) -> DataFrame:
    """The rows of some days; on a partition column this prunes folders."""
    return rows.where(F.col(_DAY).isin([F.lit(d).cast("date") for d in days]) if days else F.lit(False))


def _overwrite(rows: DataFrame, folder: str, days: list[str], *, rebalance: bool = True) -> None:
    """Replace the folders of the days that ``rows`` has; all others keep their files."""
    if not days:
        return
    rows = rows.hint("rebalance", _DAY) if rebalance else rows
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(_DAY).parquet(folder)


def _drop_days(spark: SparkSession, folder: str, days: list[str]) -> None:
    for day in days:
        delete(spark, f"{folder}/{_DAY}={day}")


def _from_release_on(changed: list[str], unchanged: list[str], market_days: list[str]) -> set[str]:
    """The market days whose newest release may be one of the changed days': those from
    each of them to the day before the next unchanged one."""
    out: set[str] = set()
    for day in changed:
        nxt = bisect_right(unchanged, day)
        until = unchanged[nxt] if nxt < len(unchanged) else "9999-99-99"
        out.update(d for d in market_days if day <= d < until)
    return out


def _correlation_after(
    aligned: DataFrame, touched: list[str], market_days: list[str]
) -> tuple[DataFrame, list[str]]:
    """The correlation of the days whose windows reach a touched day, and these days.

    A row is concerned if it is among the first 30 of its symbol from a touched day on;
    that also holds where the touched day itself is gone. Of the other rows only those
    are read on that the windows of these days reach back to.
    """
    since = [(d, touched[at - 1]) for d in market_days if (at := bisect_right(touched, d))]
    calendar = aligned.sparkSession.createDataFrame(since, "day string, since string")
    calendar = calendar.select(F.col("day").cast("date").alias(_DAY), "since")
    by_symbol = Window.partitionBy("symbol", "since").orderBy(_DAY)
    ranked = aligned.select("symbol", _DAY).join(calendar, _DAY).withColumn("n", F.row_number().over(by_symbol))
    concerned = ranked.where(F.col("n") <= FRAME).select(F.col(_DAY).cast("string")).distinct()
    days = sorted(r[0] for r in concerned.toLocalIterator())
    ahead = Window.partitionBy("symbol").orderBy(_DAY).rowsBetween(0, FRAME - 1)
    wanted = F.col(_DAY).isin([F.lit(d).cast("date") for d in days]) if days else F.lit(False)
    needed = aligned.withColumn("_near", F.max(wanted).over(ahead)).where("_near").drop("_near")
    return _of_days(correlation_daily(needed), days), days
