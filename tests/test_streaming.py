from __future__ import annotations

import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.builders import Drop, bars, encode, releases, tick_rows, tick_stream, ticks
from tests.conftest import ms, utc
from tickmacro import files
from tickmacro.checks import tables as checked
from tickmacro.operators.bars import build_bars
from tickmacro.operators.enrich import enrich
from tickmacro.operators.serving import read_serving
from tickmacro.operators.silver import silver_bars
from tickmacro.operators.state import latest_state
from tickmacro.schemas import BAR, MACRO_STATE, RELEASE_EVENT, TICK_EVENT
from tickmacro.sources import tables
from tickmacro.sources.events import decode_releases, drop_resent, route_dead_letters
from tickmacro.streaming import enrichment, jobs

ONCE = {"availableNow": True}
CLOSING = ("Z", 1.0, 1, 86_400_000)


def _drop_ticks(spark, drop, *files):
    for rows in files:
        drop.add(encode(spark, TICK_EVENT, tick_rows(*rows)))


def _run_bars(spark, drop, root, files=1):
    query = jobs.start_bars(
        tick_stream(spark, drop, files), f"{root}/bars", f"{root}/run/bars", trigger=ONCE
    )
    query.awaitTermination()
    return query


def _same(left, right):
    columns = right.columns
    assert left.select(*columns).exceptAll(right).count() == 0
    assert right.exceptAll(left.select(*columns)).count() == 0


def test_streamed_bars_equal_batch_bars(spark, tmp_path):
    rows = [("AB"[i % 2], float(i % 17), i, i * 1500) for i in range(300)]
    drop = Drop(tmp_path / "in")
    _drop_ticks(spark, drop, rows[:100], rows[100:200], rows[200:], [CLOSING])
    _run_bars(spark, drop, tmp_path)
    got = tables.read_bars(spark, f"{tmp_path}/bars")
    _same(got, build_bars(ticks(spark, *rows)))


def test_a_tick_later_than_the_watermark_is_dropped(spark, tmp_path):
    drop = Drop(tmp_path / "in")
    _drop_ticks(
        spark,
        drop,
        [("G", 1.0, 1, 1_000), ("G", 1.0, 1, 30_000), ("G", 1.0, 1, 59_000)],
        [("G", 1.0, 1, 75_000)],
        [("G", 1.0, 1, 2_000), ("G", 1.0, 1, 130_000)],
        [("G", 1.0, 1, 3_000), ("G", 1.0, 1, 300_000)],
        [CLOSING],
    )
    query = _run_bars(spark, drop, tmp_path)
    got = tables.read_bars(spark, f"{tmp_path}/bars").orderBy("window_start").collect()
    assert got[0]["tick_count"] == 4
    assert sum(r["tick_count"] for r in got) == 7
    dropped = [
        op["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for op in progress["stateOperators"]
    ]
    assert sum(dropped) == 1


def test_a_restart_neither_repeats_nor_loses_bars(spark, tmp_path):
    rows = [("G", float(i), 1, i * 1000) for i in range(240)]
    drop = Drop(tmp_path / "in")
    _drop_ticks(spark, drop, rows[:100])
    _run_bars(spark, drop, tmp_path)
    _drop_ticks(spark, drop, rows[100:], [CLOSING])
    _run_bars(spark, drop, tmp_path)
    _same(tables.read_bars(spark, f"{tmp_path}/bars"), build_bars(ticks(spark, *rows)))
    follow = tables.read_bars(spark, f"{tmp_path}/bars", streaming=True, max_files=1)
    for _ in range(2):
        jobs.start_silver_bars(
            follow, f"{tmp_path}/silver", f"{tmp_path}/run/silver", trigger=ONCE
        ).awaitTermination()
    _same(
        tables.silver_bars(spark, f"{tmp_path}/silver"),
        silver_bars(build_bars(ticks(spark, *rows))),
    )


def test_serving_stream_refuses_late_bars_and_partitions_by_hour(spark, tmp_path):
    source = str(tmp_path / "bars")
    now = utc("2024-01-01 12:00")
    bars(
        spark, ("G", utc("2024-01-01 09:00"), 1.0), ("G", utc("2024-01-01 11:00"), 2.0)
    ).write.parquet(source)
    jobs.start_serving(
        tables.read_bars(spark, source, streaming=True),
        f"{tmp_path}/serving",
        f"{tmp_path}/run",
        as_of=now,
        trigger=ONCE,
    ).awaitTermination()
    rows = read_serving(spark, f"{tmp_path}/serving").collect()
    assert [(r["hour"], r["close_price_sum"]) for r in rows] == [("2024-01-01-11", 2.0)]


def test_dead_letters_go_to_their_topic(spark, tmp_path):
    drop = Drop(tmp_path / "in")
    good = encode(spark, TICK_EVENT, tick_rows(("G", 1.0, 1, 0)))
    drop.add([*good, "{bad", '{"payload": {"price": "x"}}'])
    raw = drop.stream(spark).withColumn("key", F.lit("k"))
    routed = route_dead_letters(raw, TICK_EVENT, topic="live", dead_topic="dead")
    jobs.start_routed(routed, f"{tmp_path}/out", f"{tmp_path}/run", trigger=ONCE).awaitTermination()
    out = jobs.read_routed(spark, f"{tmp_path}/out")
    assert dict(out.groupBy("topic").count().collect()) == {"live": 1, "dead": 2}


def _release_rows(*rows):
    """(series, value, release_ms, arrival)."""
    return [
        (str(n), "test", s, at, n, "v1", (s, "2024-01-01", v, at, "2024-01-01", "2024-01-01"))
        for s, v, at, n in rows
    ]


def _drop_releases(spark, drop, *files):
    for rows in files:
        drop.add(encode(spark, RELEASE_EVENT, _release_rows(*rows)))


ARRIVALS = [
    [("DFF", 3.0, 300, 1), ("CPI", 8.0, 50, 2)],
    [("DFF", 2.0, 200, 3)],
    [("CPI", 9.0, 60, 4)],
    [("DFF", 1.0, 100, 5), ("DFF", 0.5, 90, 6)],
]


def test_streamed_state_is_the_last_arrival_and_compacts(spark, tmp_path):
    drop = Drop(tmp_path / "in")
    _drop_releases(spark, drop, *ARRIVALS)
    path = f"{tmp_path}/state"
    jobs.start_macro_state(
        decode_releases(drop.stream(spark)),
        path,
        f"{tmp_path}/run",
        arrival="ingest_ts_ms",
        trigger=ONCE,
    ).awaitTermination()
    want = latest_state(
        releases(spark, *[r for rows in ARRIVALS for r in rows]), arrival="ingest_ts_ms"
    )
    _same(jobs.read_macro_state(spark, path), want)
    assert jobs.read_changelog(spark, path, MACRO_STATE).count() > 2
    before = jobs.read_changelog(spark, path, MACRO_STATE).count()
    assert jobs.compact_changelog(spark, path, MACRO_STATE, ["series_id"]) is not None
    assert jobs.compact_changelog(spark, path, MACRO_STATE, ["series_id"]) is None
    _same(jobs.read_macro_state(spark, path), want)
    assert jobs.read_changelog(spark, path, MACRO_STATE).count() < before


def test_a_compacted_changelog_goes_on_and_does_not_grow(spark, tmp_path):
    path, want = str(tmp_path / "log"), {}
    folders = []
    for n in range(7):
        rows = [("A", float(n), n), (f"S{n % 3}", float(10 * n), n)]
        batch = spark.createDataFrame(rows, MACRO_STATE)
        want |= {r[0]: r[1] for r in rows}
        jobs.write_batch(batch, path, n)
        if n == 3:
            # Broken off: no base to be seen.
            (tmp_path / "log" / "_base" / "upto=9").mkdir(parents=True, exist_ok=True)
        jobs.compact_changelog(spark, path, MACRO_STATE, ["series_id"])
        jobs.write_batch(batch, path, n)  # the newest batch, repeated
        folders.append(len(list((tmp_path / "log").glob("batch_id=*"))))
        latest = jobs.read_macro_state(spark, path).collect()
        assert {r["series_id"]: r["macro_value"] for r in latest} == want
    assert max(folders[2:]) <= 3


class _Feed:
    """Bars and releases that arrive in turn; one file of each per batch."""

    def __init__(self, spark, tmp_path):
        self.spark, self.root = spark, tmp_path
        self.bars, self.releases = Drop(tmp_path / "bars-in"), Drop(tmp_path / "releases-in")

    def step(self, bar_rows=(), release_rows=(), **kw):
        if bar_rows:
            df = bars(self.spark, *bar_rows)
            self.bars.add([r[0] for r in df.select(F.to_json(F.struct("*"))).collect()])
        if release_rows:
            _drop_releases(self.spark, self.releases, release_rows)
        self.run(**kw)

    def run(self, **kw):
        raw = self.bars.stream(self.spark)
        decoded = raw.select(F.from_json("value", BAR).alias("b")).select("b.*")
        enrichment.start_enrichment(
            decoded,
            decode_releases(self.releases.stream(self.spark)),
            f"{self.root}/enriched",
            f"{self.root}/run",
            arrival=F.col("ingest_ts_ms"),
            trigger=ONCE,
            **kw,
        ).awaitTermination()

    def table(self):
        return enrichment.read_enriched(self.spark, f"{self.root}/enriched")

    def emitted(self):
        rows = enrichment.emissions(self.spark, f"{self.root}/enriched")
        return rows.agg(F.coalesce(F.sum("versions"), F.lit(0))).first()[0]


def _at(minute):
    return utc(f"2024-01-01 10:{minute:02d}")


STEPS = [
    ([("G", _at(0), 1.0), ("H", _at(0), 2.0)], []),
    ([], [("DFF", 3.0, ms("2024-01-01 09:00"), 1), ("CPI", 9.0, 0, 2)]),
    ([("G", _at(1), 4.0)], []),
    ([("G", _at(2), 5.0)], [("DFF", 2.0, ms("2023-12-31"), 3)]),
    ([("H", _at(2), 6.0)], [("CPI", 7.0, 0, 4)]),
]


def test_streamed_enrichment_ends_as_the_plain_join(spark, tmp_path):
    feed = _Feed(spark, tmp_path)
    emitted = []
    for bar_rows, release_rows in STEPS:
        feed.step(bar_rows, release_rows)
        emitted.append(feed.emitted())
        _same(enrichment.view_enriched(spark, f"{tmp_path}/enriched"), feed.table())
    all_bars = bars(spark, *[b for rows, _ in STEPS for b in rows])
    all_releases = releases(spark, *[r for _, rows in STEPS for r in rows])
    state = latest_state(all_releases, arrival="ingest_ts_ms")
    _same(feed.table(), enrich(all_bars, state))
    # Nothing before the first value; then both bars; a new bar; a new bar and
    # three earlier ones; a new bar only, for the other series changed.
    assert emitted == [0, 2, 3, 7, 8]


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    feed = _Feed(spark, tmp_path)
    for step in STEPS[:4]:
        feed.step(*step)
    before, emitted = feed.table().collect(), feed.emitted()
    # As after a crash between the write and the commit of the last batch.
    last = max((tmp_path / "run" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    shutil.move(last, tmp_path / "lost-commit")
    crc = last.with_name(f".{last.name}.crc")
    if crc.exists():
        shutil.move(crc, tmp_path / "lost-commit-crc")
    feed.run()
    assert feed.emitted() == emitted
    assert sorted(map(str, feed.table().collect())) == sorted(map(str, before))


def test_enrichment_without_re_emission_gives_each_bar_once(spark, tmp_path):
    feed = _Feed(spark, tmp_path)
    for step in STEPS:
        feed.step(*step, reemit=False)
    got = {(r["symbol"], r["window_start"].minute): r["macro_value"] for r in feed.table().collect()}
    assert got == {("G", 1): 3.0, ("G", 2): 2.0, ("H", 2): 2.0}
    joined = enrichment.view_enriched(spark, f"{tmp_path}/enriched")
    assert {r["macro_value"] for r in joined.collect()} == {2.0} and joined.count() == 5
    assert feed.emitted() == 3


def test_a_bar_sent_again_replaces_the_earlier_one(spark, tmp_path):
    feed = _Feed(spark, tmp_path)
    feed.step([("G", _at(0), 1.0)], [("DFF", 1.0, 0, 1)])
    feed.step([("G", _at(0), 2.0)], [])
    feed.step([], [("DFF", 5.0, 0, 2)])
    rows = feed.table().collect()
    assert [(r["close_price"], r["macro_value"]) for r in rows] == [(2.0, 5.0)]
    _same(enrichment.view_enriched(spark, f"{tmp_path}/enriched"), feed.table())


def test_console_sink_prints_instead_of_sending(spark, tmp_path):
    drop = Drop(tmp_path / "in")
    drop.add(["one"])
    query = jobs.start_append(
        drop.stream(spark), None, str(tmp_path / "run"), fmt="console", trigger=ONCE
    )
    query.awaitTermination()
    assert query.exception() is None


@pytest.mark.parametrize("reemit", [True, False])
def test_first_batch_may_lack_either_side(spark, tmp_path, reemit):
    feed = _Feed(spark, tmp_path)
    feed.step([], [("CPI", 1.0, 0, 1)], reemit=reemit)
    assert feed.table().count() == 0


def test_resent_ticks_can_be_dropped_from_a_stream(spark, tmp_path):
    rows = [("G", float(i), 1, i * 1000) for i in range(1, 31)]
    drop = Drop(tmp_path / "in")
    _drop_ticks(spark, drop, rows, rows[20:], [CLOSING])
    once = drop_resent(tick_stream(spark, drop), ["entity_key", "event_ts_ms"])
    jobs.start_append(
        once.select("entity_key", "event_ts_ms"), f"{tmp_path}/out", f"{tmp_path}/run", trigger=ONCE
    ).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(rows) + 1


DAY_MS = 86_400_000


def _bars_of_days(spark, tmp_path, days):
    """Bars of so many days, all in one micro-batch that closes them."""
    drop = Drop(tmp_path / "in")
    rows = [("ABCDEFGH"[i % 8], float(i), 1, i % days * DAY_MS + i * 60_000) for i in range(days * 40)]
    _drop_ticks(spark, drop, [*rows, ("Z", 1.0, 1, (days + 2) * DAY_MS)])
    _run_bars(spark, drop, tmp_path)
    return rows


def test_a_batch_of_closed_bars_has_one_file_for_each_day(spark, tmp_path):
    rows = _bars_of_days(spark, tmp_path, 3)
    found = [name.split("/")[0] for name in files.data_files(spark, f"{tmp_path}/bars")]
    assert sorted(found) == ["dt=1970-01-01", "dt=1970-01-02", "dt=1970-01-03"]
    _same(tables.read_bars(spark, f"{tmp_path}/bars"), build_bars(ticks(spark, *rows)))


def test_a_stream_gets_its_session_back_as_it_was(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    drop, seen = Drop(tmp_path / "in"), []
    _drop_ticks(spark, drop, [("A", 1.0, 1, 0)], [("A", 1.0, 1, DAY_MS)])

    def write(batch, batch_id):
        batch.collect()
        seen.append(batch.sparkSession.conf.get("spark.sql.adaptive.enabled"))

    stream = build_bars(tick_stream(spark, drop))
    jobs.start_foreach(stream, write, f"{tmp_path}/run", trigger=ONCE).awaitTermination()
    assert len(seen) >= 2 and set(seen) == {"true"}
    assert spark.conf.get("spark.sql.adaptive.enabled") == before


def _state_partitions(query):
    return {op["numShufflePartitions"] for progress in query.recentProgress for op in progress["stateOperators"]}


def test_state_is_not_spread_over_more_partitions_than_a_stream_needs(spark, tmp_path):
    name = "spark.sql.shuffle.partitions"
    before, rows = spark.conf.get(name), [("AB"[i % 2], float(i % 17), i, i * 1500) for i in range(300)]
    drop = Drop(tmp_path / "in")
    start = lambda at, **kw: jobs.start_bars(
        tick_stream(spark, drop), f"{tmp_path}/{at}", f"{tmp_path}/run/{at}", trigger=ONCE, **kw
    )
    _drop_ticks(spark, drop, rows[:150])
    seen = {}
    try:
        for n in (0, 1):
            for at, session, kw in (
                ("bounded", 40, {}),
                ("few", 3, {}),
                # Its checkpoint began with the session's number and keeps it.
                ("older", 40, {} if n else {"state_partitions": None}),
            ):
                spark.conf.set(name, str(session))
                query = start(at, **kw)
                query.awaitTermination()
                assert spark.conf.get(name) == str(session)
                seen.setdefault(at, set()).update(_state_partitions(query))
            if n == 0:
                _drop_ticks(spark, drop, rows[150:], [CLOSING])
    finally:
        spark.conf.set(name, before)
    assert seen == {"bounded": {jobs.STATE_PARTITIONS}, "few": {3}, "older": {40}}
    for at in seen:
        _same(tables.read_bars(spark, f"{tmp_path}/{at}"), build_bars(ticks(spark, *rows)))


def test_parts_in_time_look_for_the_ends_once(spark, tmp_path):
    schema = checked.SCHEMAS["events"]
    at = lambda *minutes: [(i, None if m is None else datetime(2024, 1, 1, 0, m), 1, "a", 1.0, None) for i, m in enumerate(minutes)]
    for minutes, parts in (((0, 7, 30, 44, 59, None), [0, 0, 2, 2, 3, 3]), ((5, 5), [0, 0]), ((None,), [3]), ((), [])):
        events = spark.createDataFrame(at(*minutes), schema)
        marked = events.select("event_id", checked.part_in_time(events).alias("part"))
        assert [r.part for r in marked.orderBy("event_id").collect()] == parts
        assert "subquery" not in marked._jdf.queryExecution().toString().lower()
