"""Few files instead of many in the folders that streams append to.

A folder of a partition (a day or an hour) gets a file or more with every micro-batch.
``merge_folders`` writes its rows into few files below ``_merged`` and then, by renaming
one small file into place, a record of the files they replace. Readers of this library
take the merged files and whatever is in the folder and not in the record, so a swap
is seen whole or not at all; files that come meanwhile are simply not in the record.
What is replaced stays until ``grace`` has passed, for readers that listed it before.
Those who read the folder by other means must read it before the grace is over, or the
merged copy with it; streams that follow a folder should be ahead of it.
"""

from __future__ import annotations

import math
from collections import defaultdict
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tickmacro.files import MERGED, children, data_files, delete, exists, file_system
from tickmacro.operators.retention import GRACE

_RECORD = "replaced"


def _rounds(spark: SparkSession, path: str, value: str) -> list[str]:
    """The finished rounds of merging of one folder, oldest first."""
    folder = f"{path}/{MERGED}/{value}"
    return [n for n in children(spark, folder) if exists(spark, f"{folder}/{n}/{_RECORD}")]


def _replaced(spark: SparkSession, path: str, value: str, number: str) -> set[str]:
    # Opened as it was written: a Spark job for each folder and round would take longer than the names do.
    files, record = file_system(spark, f"{path}/{MERGED}/{value}/{number}/{_RECORD}")
    opened = files.open(record)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()
    return {name for name in text.split("\n") if name}


def read_folders(
    spark: SparkSession, path: str, schema: StructType, column: str, values: list[str] | None = None
) -> DataFrame:
    """The rows of a table in folders by ``column``, merged files instead of those they
    replace; with ``values`` of these folders alone.

    ``schema`` has the column. Without any merging it is the plain scan.
    """
    names = schema.fieldNames()
    merged = {v: _rounds(spark, path, v) for v in children(spark, f"{path}/{MERGED}")}
    merged = {v: rounds[-1] for v, rounds in merged.items() if rounds and (values is None or v in values)}
    if not merged and values is None:
        return spark.read.schema(schema).parquet(path).select(*names)
    folders = [c for c in children(spark, path) if c.startswith(f"{column}=")]
    plain, loose = [], []
    for folder in folders:
        value = folder.split("=", 1)[1]
        if values is not None and value not in values:
            continue
        if value not in merged:
            plain.append(f"{path}/{folder}")
            continue
        gone = _replaced(spark, path, value, merged[value])
        loose += [f"{path}/{folder}/{n}" for n in data_files(spark, f"{path}/{folder}") if n not in gone]
    out = spark.createDataFrame([], schema)
    if plain or loose:
        out = spark.read.schema(schema).option("basePath", path).parquet(*plain, *loose).select(*names)
    if merged:
        parts = [f"{path}/{MERGED}/{v}/{n}/rows" for v, n in sorted(merged.items())]
        out = out.unionByName(spark.read.schema(schema).parquet(*parts).select(*names))
    return out


def merge_folders(
    spark: SparkSession,
    path: str,
    schema: StructType,
    column: str,
    *,
    least: int = 8,
    before: str | None = None,
    target_bytes: int = 128 << 20,
    grace: timedelta = GRACE,
) -> list[str]:
    """Merge every folder with ``least`` live files or more, only those whose value lies
    before ``before`` if it is given. Returns the values of the merged folders.

    A streaming writer may go on. Merges of one table must not run side by side. One that
    broke off leaves no record and is made again. Then what earlier rounds replaced goes,
    once their ``grace`` is over. Names of files pass the driver, folder by folder.
    """
    path, done = path.rstrip("/"), []
    for folder in [c for c in children(spark, path) if c.startswith(f"{column}=")]:
        value = folder.split("=", 1)[1]
        if before is not None and value >= before:
            continue
        rounds, found = _rounds(spark, path, value), data_files(spark, f"{path}/{folder}")
        gone = _replaced(spark, path, value, rounds[-1]) if rounds else set()
        live = {n: state for n, state in found.items() if n not in gone}
        if len(live) >= least:
            number = f"{int(rounds[-1]) + 1 if rounds else 0:010d}"
            home = f"{path}/{MERGED}/{value}/{number}"
            sources = [f"{path}/{folder}/{n}" for n in sorted(live)]
            rows = spark.read.schema(schema).option("basePath", path).parquet(*sources).select(*schema.fieldNames())
            size = sum(length for length, _ in live.values())
            if rounds:
                last = f"{path}/{MERGED}/{value}/{rounds[-1]}/rows"
                rows = rows.unionByName(spark.read.schema(schema).parquet(last).select(*schema.fieldNames()))
                size += sum(length for length, _ in data_files(spark, last).values())
            few = rows.coalesce(max(1, math.ceil(size / target_bytes)))
            few.write.mode("overwrite").parquet(f"{home}/rows")
            _record(spark, home, sorted({*live, *(gone & set(found))}))
            done.append(value)
        _sweep(spark, path, folder, value, grace)
    return done


def _record(spark: SparkSession, home: str, names: list[str]) -> None:
    files, temporary = file_system(spark, f"{home}/_{_RECORD}")
    out = files.create(temporary, True)
    out.write(bytearray("\n".join(names).encode()))
    out.close()
    if not files.rename(temporary, file_system(spark, f"{home}/{_RECORD}")[1]):
        raise OSError(f"the record of {home} could not be put in place")


def _sweep(spark: SparkSession, path: str, folder: str, value: str, grace: timedelta) -> None:
    """Delete what a round replaced whose grace is over: files, and the rounds before it."""
    until = datetime.now(timezone.utc) - grace
    ripe = []
    for number in _rounds(spark, path, value):
        files, record = file_system(spark, f"{path}/{MERGED}/{value}/{number}/{_RECORD}")
        since = datetime.fromtimestamp(files.getFileStatus(record).getModificationTime() / 1000, timezone.utc)
        if since <= until:
            ripe.append(number)
    if not ripe:
        return
    for name in _replaced(spark, path, value, ripe[-1]):
        delete(spark, f"{path}/{folder}/{name}")
    for number in ripe[:-1]:
        delete(spark, f"{path}/{MERGED}/{value}/{number}")


def live_files(spark: SparkSession, path: str, column: str) -> dict[str, int]:
    """How many files a reader opens for each folder."""
    out: dict[str, int] = defaultdict(int)
    for name in data_files(spark, path):
        out[name.split("/", 1)[0].split("=", 1)[-1]] += 1
    for value in children(spark, f"{path}/{MERGED}"):
        rounds = _rounds(spark, path, value)
        if rounds:
            gone = _replaced(spark, path, value, rounds[-1])
            out[value] -= sum(n in gone for n in data_files(spark, f"{path}/{column}={value}"))
            out[value] += len(data_files(spark, f"{path}/{MERGED}/{value}/{rounds[-1]}/rows"))
    return dict(out)
