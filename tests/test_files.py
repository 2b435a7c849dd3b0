"""Folders of plain files that streams append to: exactly once, whatever breaks off."""

from __future__ import annotations

import os
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.builders import Drop, bars, encode, tick_rows, tick_stream
from tests.conftest import utc
from tickmacro import files
from tickmacro.operators import retention
from tickmacro.operators.silver import silver_bars
from tickmacro.schemas import (
    ANALYTICS_TOPIC,
    BAR_TOPIC,
    RETENTION_DAYS,
    SILVER_BAR,
    STATE_TOPIC,
    TICK_DEAD_TOPIC,
    TICK_EVENT,
    TICK_TOPIC,
)
from tickmacro.sources import tables
from tickmacro.sources.events import route_dead_letters
from tickmacro.streaming import enrichment, jobs, merging

ONCE = {"availableNow": True}
DAY = 86_400_000


def _rows(spark, n, first=0):
    at = F.expr(f"timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, id % 3, 0, id)")
    return spark.range(first, first + n).select("id", at.alias("at")).withColumn("dt", F.to_date("at"))


def _ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).select("id").collect())


def _data_files(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("dt=*/*.parquet") if not any(x.startswith("_") for x in p.relative_to(path).parts))


def test_a_batch_is_published_once(spark, tmp_path):
    path = tmp_path / "t"
    for n in (0, 1, 1, 2, 2):
        files.publish_batch(_rows(spark, 10, 10 * n), str(path), "s", n, ["dt"])
    assert _ids(spark, str(path)) == list(range(30))
    assert files.children(spark, f"{path}/_done") == ["s-2"] and files.children(spark, f"{path}/_staging") == []
    assert not (path / "_spark_metadata").exists()
    # Another stream with batches of the same numbers.
    files.publish_batch(_rows(spark, 5, 90), str(path), "other", 2, ["dt"])
    assert _ids(spark, str(path)) == [*range(30), *range(90, 95)]


@pytest.mark.parametrize("broken", ["write", "first rename", "later rename", "mark"])
def test_a_batch_that_broke_off_goes_on(spark, tmp_path, monkeypatch, broken):
    path, calls = tmp_path / "t", []
    files.publish_batch(_rows(spark, 10), str(path), "s", 0, ["dt"])
    rows = _rows(spark, 10, 10).repartition(3)
    if broken == "write":
        # Files without _SUCCESS: the write was cut short and is done again.
        _rows(spark, 99, 500).write.partitionBy("dt").parquet(f"{path}/_staging/s-1")
        os.remove(path / "_staging" / "s-1" / "_SUCCESS")
    elif broken == "mark":
        real = files.touch
        monkeypatch.setattr(files, "touch", lambda *a: (_ for _ in ()).throw(OSError("stop")))
        with pytest.raises(OSError, match="stop"):
            files.publish_batch(rows, str(path), "s", 1, ["dt"])
        monkeypatch.setattr(files, "touch", real)
    else:
        rows.write.partitionBy("dt").parquet(f"{path}/_staging/s-1")
        staged = sorted(p for p in (path / "_staging" / "s-1").rglob("part-*.parquet"))
        for p in staged[: 0 if broken == "first rename" else 2]:
            target = path / p.parent.name
            target.mkdir(exist_ok=True)
            os.rename(p, target / f"s-0000000001-{p.name}")
    seen = _data_files(path)
    files.publish_batch(rows, str(path), "s", 1, ["dt"])
    assert _ids(spark, str(path)) == list(range(20)) and set(seen) <= set(_data_files(path))


def test_an_empty_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    files.publish_batch(_rows(spark, 4), path, "s", 0, ["dt"])
    files.publish_batch(_rows(spark, 0), path, "s", 1, ["dt"])
    assert _ids(spark, path) == [0, 1, 2, 3]


def _ticks(spark, drop, *days):
    drop.add(encode(spark, TICK_EVENT, tick_rows(*[("G", float(d), 1, d * DAY + 1000) for d in days])))


def test_stream_written_silver_is_a_catalog_table(spark, tmp_path):
    drop = Drop(tmp_path / "in")
    _ticks(spark, drop, 1, 2)
    _ticks(spark, drop, 3)
    _ticks(spark, drop, 9)
    jobs.start_bars(tick_stream(spark, drop), f"{tmp_path}/bars", f"{tmp_path}/run/bars", trigger=ONCE).awaitTermination()
    follow = tables.read_bars(spark, f"{tmp_path}/bars", streaming=True, max_files=1)
    path = f"{tmp_path}/silver"
    for n in range(2):
        if n:
            last = max(int(c) for c in files.children(spark, f"{tmp_path}/run/silver/commits") if c.isdigit())
            files.delete(spark, f"{tmp_path}/run/silver/commits/{last}")
        jobs.start_silver_bars(follow, path, f"{tmp_path}/run/silver", trigger=ONCE).awaitTermination()
    spark.sql("DROP TABLE IF EXISTS streamed_silver")
    tables.create_external_table(spark, "streamed_silver", SILVER_BAR, path)
    want = silver_bars(tables.read_bars(spark, f"{tmp_path}/bars"))
    for got in (spark.table("streamed_silver").select(*SILVER_BAR.fieldNames()), tables.silver_bars(spark, path)):
        assert got.count() == 3 and got.exceptAll(want).isEmpty()
    # A day that comes later is there after a refresh.
    _ticks(spark, drop, 12)
    jobs.start_bars(tick_stream(spark, drop), f"{tmp_path}/bars", f"{tmp_path}/run/bars", trigger=ONCE).awaitTermination()
    jobs.start_silver_bars(follow, path, f"{tmp_path}/run/silver", trigger=ONCE).awaitTermination()
    tables.refresh_partitions(spark, "streamed_silver")
    assert spark.table("streamed_silver").count() == 4
    spark.sql("DROP TABLE streamed_silver")


def test_expiry_hides_first_and_deletes_after_the_grace(spark, tmp_path):
    path = tmp_path / "t"
    files.publish_batch(_rows(spark, 9), str(path), "s", 0, ["dt"])
    as_of, hour = date(2024, 1, 3), timedelta(hours=1)
    reader = spark.read.parquet(str(path))
    assert retention.expire_folder(spark, str(path), 1, as_of, grace=hour) == []
    assert {str(r.dt) for r in retention.live(spark, spark.read.parquet(str(path)), str(path)).collect()} == {"2024-01-02", "2024-01-03"}
    assert reader.count() == 9 and (path / "dt=2024-01-01").exists()
    old = datetime.now(timezone.utc) - 2 * hour
    os.utime(path / "_expired" / "before=2024-01-02", (old.timestamp(), old.timestamp()))
    assert retention.expire_folder(spark, str(path), 1, as_of, grace=hour) == ["dt=2024-01-01"]
    # The writer goes on, a late row of an expired day is hidden at once and goes later.
    files.publish_batch(_rows(spark, 3, 90), str(path), "s", 1, ["dt"])
    rows = retention.live(spark, spark.read.parquet(str(path)), str(path))
    assert {str(r.dt) for r in rows.collect()} == {"2024-01-02", "2024-01-03"} and rows.count() == 8
    assert retention.expire_folder(spark, str(path), 1, as_of, grace=hour) == ["dt=2024-01-01"]
    assert retention.expire_folder(spark, str(path), 1, as_of, grace=hour) == []
    assert retention.expire_folder(spark, str(tmp_path / "none"), 1, as_of) == []


def test_every_topic_of_running_streams_expires(spark, tmp_path):
    drop, bad = Drop(tmp_path / "in"), Drop(tmp_path / "raw")
    newest, root = date(1970, 3, 1), str(tmp_path)
    folders = {
        TICK_TOPIC: f"{root}/events/topic={TICK_TOPIC}",
        TICK_DEAD_TOPIC: f"{root}/events/topic={TICK_DEAD_TOPIC}",
        BAR_TOPIC: f"{root}/bars",
        ANALYTICS_TOPIC: f"{root}/enriched/out",
        STATE_TOPIC: f"{root}/enriched/state",
    }
    releases = Drop(tmp_path / "releases")
    releases.add([])
    from tests.test_streaming import _drop_releases

    _drop_releases(spark, releases, [("DFF", 1.0, 0, 1)])
    from tickmacro.sources.events import decode_releases

    for days in ([1, 20, 45, 50], [55, 59], [70]):
        _ticks(spark, drop, *days)
        bad.add([line for d in days for line in (encode(spark, TICK_EVENT, tick_rows(("G", 1.0, 1, d * DAY)))[0], f"broken {d}")])
        raw = bad.stream(spark)
        routed = route_dead_letters(
            raw.withColumn("key", F.lit("k")), TICK_EVENT, topic=TICK_TOPIC, dead_topic=TICK_DEAD_TOPIC
        )
        day = F.date_from_unix_date(
            F.coalesce(
                (F.get_json_object("value", "$.event_ts_ms").cast("bigint") / DAY).cast("int"),
                F.regexp_extract("value", "broken (.*)", 1).try_cast("int"),
            )
        )
        jobs.start_routed(routed, f"{root}/events", f"{root}/run/events", day=day, trigger=ONCE).awaitTermination()
        jobs.start_bars(tick_stream(spark, drop), f"{root}/bars", f"{root}/run/bars", trigger=ONCE).awaitTermination()
        enrichment.start_enrichment(
            tables.read_bars(spark, f"{root}/bars", streaming=True),
            decode_releases(releases.stream(spark)),
            f"{root}/enriched",
            f"{root}/run/enriched",
            arrival=F.col("ingest_ts_ms"),
            trigger=ONCE,
        ).awaitTermination()
        gone = retention.expire_topics(spark, folders, newest, grace=timedelta(0))
        assert STATE_TOPIC not in gone
    first = date(1970, 1, 1)
    events = jobs.read_routed(spark, f"{root}/events", dated=True)
    for topic in (TICK_TOPIC, TICK_DEAD_TOPIC):
        left = {(r.dt - first).days for r in events.where(F.col("topic") == topic).collect()}
        assert left == {d for d in (1, 20, 45, 50, 55, 59, 70) if d >= 59 - RETENTION_DAYS[topic]}
        on_disk = {c for c in files.children(spark, folders[topic]) if c.startswith("dt=")}
        assert len(on_disk) == len(left)
    left = {(r.window_start.date() - first).days for r in tables.read_bars(spark, folders[BAR_TOPIC]).collect()}
    assert left == {45, 50, 55, 59}
    kept = {(r.window_start.date() - first).days for r in enrichment.read_enriched(spark, f"{root}/enriched").collect()}
    assert kept == left
    assert all("1970-01-21" not in c for c in files.children(spark, f"{root}/enriched/out/batch_id=0"))


def test_enriched_days_are_pruned(spark, tmp_path):
    root = str(tmp_path)
    rows = bars(spark, *[("G", utc(f"2024-01-0{d} 10:00"), float(d)) for d in (1, 2, 3)])
    out = rows.select(
        "symbol", "window_start", "close_price", "volume", "tick_count", F.lit("DFF").alias("series_id"),
        F.lit(1.0).alias("macro_value"), F.lit(0).cast("long").alias("release_ts_ms"), F.lit(0).cast("long").alias("macro_age_minutes"),
        F.lit(0).cast("long").alias("bar_batch"), F.to_date("window_start").alias("dt"),
    )
    for n in range(3):
        jobs.write_batch(out.withColumn("macro_value", F.lit(float(n))), f"{root}/out", n, ["dt"])
    assert {r.versions for r in enrichment.emissions(spark, root).collect()} == {3}
    some = enrichment.read_enriched(spark, root, since=date(2024, 1, 2), until=date(2024, 1, 2))
    assert [(r.close_price, r.macro_value) for r in some.collect()] == [(2.0, 2.0)]
    assert "PartitionFilters: [isnotnull(dt" in some._jdf.queryExecution().toString()
    assert enrichment.compact_enriched(spark, root) == 1
    assert {r.versions for r in enrichment.emissions(spark, root).collect()} == {2}
    assert enrichment.read_enriched(spark, root).count() == 3


def test_many_files_become_few_and_readers_see_one_table(spark, tmp_path):
    path, schema = str(tmp_path / "t"), _rows(spark, 0).schema
    read = lambda: sorted(r.id for r in merging.read_folders(spark, path, schema, "dt").select("id").collect())
    no_grace, first_day, total = timedelta(0), "2024-01-01", 0
    for n in range(4):
        for k in range(3):
            files.publish_batch(_rows(spark, 6, 6 * (3 * n + k)), path, "s", 3 * n + k, ["dt"])
            total += 6
        before = merging.read_folders(spark, path, schema, "dt")
        assert merging.merge_folders(spark, path, schema, "dt", least=3) == [first_day, "2024-01-02", "2024-01-03"]
        # A round that broke off has no record.
        (tmp_path / "t" / "_merged" / first_day / f"{n + 5:010d}" / "rows").mkdir(parents=True)
        assert before.count() == total and read() == list(range(total))
        assert set(merging.live_files(spark, path, "dt").values()) == {1}
        assert merging.merge_folders(spark, path, schema, "dt", least=3) == []
    some = merging.read_folders(spark, path, schema, "dt", [first_day, "2030-01-01"])
    assert {str(r.dt) for r in some.collect()} == {first_day} and some.count() == total // 3
    # After the grace what was replaced is gone, and rows are what they were.
    merging.merge_folders(spark, path, schema, "dt", least=3, grace=no_grace)
    assert _data_files(tmp_path / "t") == [] and read() == list(range(total))
    files.publish_batch(_rows(spark, 3, total), path, "s", 99, ["dt"])
    assert read() == list(range(total + 3))
    assert merging.merge_folders(spark, path, schema, "dt", least=1, before="2024-01-02", grace=no_grace) == [first_day]
    assert read() == list(range(total + 3))
    # Expiry takes merged days along.
    retention.expire_folder(spark, path, 1, date(2024, 1, 3), grace=no_grace)
    assert files.children(spark, f"{path}/_merged") == ["2024-01-02", "2024-01-03"]


def test_records_of_merging_are_read_without_a_job(spark, tmp_path):
    path, schema = str(tmp_path / "t"), _rows(spark, 0).schema
    for n in range(2):
        files.publish_batch(_rows(spark, 6, 6 * n), path, "s", n, ["dt"])
    replaced = set(files.data_files(spark, path))
    merged = merging.merge_folders(spark, path, schema, "dt", least=2)
    spark.sparkContext.setJobGroup("records", "")
    try:
        names = {f"dt={v}/{n}" for v in merged for n in merging._replaced(spark, path, v, f"{0:010d}")}
        assert merging.live_files(spark, path, "dt") == dict.fromkeys(merged, 1)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert names == replaced and len(merged) == 3
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("records") == []
