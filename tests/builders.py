"""Small inputs written by hand."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmacro.schemas import BAR, RELEASE_EVENT, SILVER_RELEASE, TICK_EVENT
from tickmacro.sources.events import decode_ticks
from tickmacro.functions.times import instant


def tick_rows(*ticks: tuple) -> list[tuple]:
    """(symbol, price, size, event_ts_ms) as envelope rows, ids in order."""
    return [
        (f"id-{i:04d}", "test", symbol, at, at, "v1", (symbol, price, size))
        for i, (symbol, price, size, at) in enumerate(ticks)
    ]


def ticks(spark: SparkSession, *rows: tuple) -> DataFrame:
    df = spark.createDataFrame(tick_rows(*rows), TICK_EVENT)
    return df.withColumn("event_time", instant("event_ts_ms"))


def releases(spark: SparkSession, *rows: tuple) -> DataFrame:
    """(series, value, release_ms, arrival) as decoded releases."""
    events = [
        (str(n), "test", s, at, n, "v1", (s, "2024-01-01", v, at, "2024-01-01", "2024-01-01"))
        for s, v, at, n in rows
    ]
    df = spark.createDataFrame(events, RELEASE_EVENT)
    return df.withColumn("event_time", instant("event_ts_ms"))


def bars(spark: SparkSession, *rows: tuple) -> DataFrame:
    """(symbol, window_start, close)."""
    return spark.createDataFrame(
        [(s, at, at, c, c, c, c, 1, 1) for s, at, c in rows], BAR
    ).withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 1 MINUTE"))


def silver_releases(spark: SparkSession, *rows: tuple) -> DataFrame:
    """(series, release instant, observation date, value)."""
    return spark.createDataFrame(
        [(None, s, obs, v, at, None, None) for s, at, obs, v in rows], SILVER_RELEASE
    ).withColumn("dt", F.to_date("release_ts_utc"))


def encode(spark: SparkSession, schema, rows: list[tuple]) -> list[str]:
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(F.to_json(F.struct("*"))).collect()]


class Drop:
    """A folder that receives text files, each newer than the one before."""

    def __init__(self, path: Path) -> None:
        self.path, self.count = path, 0
        path.mkdir(parents=True, exist_ok=True)

    def add(self, lines: list[str]) -> None:
        self.count += 1
        file = self.path / f"{self.count:04d}.txt"
        temporary = self.path / f".{file.name}"
        temporary.write_text("".join(f"{line}\n" for line in lines))
        stamp = 1_700_000_000 + self.count * 10
        os.utime(temporary, (stamp, stamp))
        temporary.rename(file)

    def stream(self, spark: SparkSession, files: int = 1) -> DataFrame:
        return (
            spark.readStream.format("text")
            .option("maxFilesPerTrigger", files)
            .load(str(self.path))
        )


def tick_stream(spark: SparkSession, drop: Drop, files: int = 1) -> DataFrame:
    return decode_ticks(drop.stream(spark, files))
