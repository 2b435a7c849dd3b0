"""Retention by age and compaction of changelogs."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmacro.files import MERGED, STAGING, children, delete, file_system, touch
from tickmacro.functions.times import as_of_column
from tickmacro.schemas import RETENTION_DAYS

#: How long what is expired stays for readers that have listed it.
GRACE = timedelta(hours=1)
_EXPIRED, _MARK = "_expired", "before="


def _check_days(days: int) -> int:
    if isinstance(days, bool) or not isinstance(days, int) or days <= 0:
        raise ValueError(f"retention days must be a positive integer, got {days!r}")
    return days


def keep_recent(
    df: DataFrame,
    time_col: str,
    days: int,
    as_of: Column | datetime | str | None = None,
) -> DataFrame:
    """Rows of the last ``days`` days and all future rows."""
    bound = as_of_column(as_of) - F.make_dt_interval(F.lit(_check_days(days)))
    return df.where(F.col(time_col) >= bound)


def keep_recent_days(
    df: DataFrame, days: int, as_of: Column | date | str | None = None, *, day_col: str = "dt"
) -> DataFrame:
    """The same by whole days; on a partition column it prunes folders."""
    if as_of is None:
        as_of = F.current_date()
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of)
    return df.where(F.col(day_col) >= F.date_sub(as_of.cast("date"), _check_days(days)))


def apply_topic_retention(
    spark: SparkSession, tables: dict[str, str], as_of: date | None = None
) -> dict[str, list[str]]:
    """Drop what each topic's retention no longer covers.

    ``tables`` maps topics to dated tables. A compacted topic is never cut by
    age. Returns the dropped days per table.
    """
    return {
        table: drop_expired_partitions(spark, table, RETENTION_DAYS[topic], as_of)
        for topic, table in tables.items()
        if RETENTION_DAYS[topic] is not None
    }


# Folders that streams write. What is expired is hidden first and deleted later, so that
# readers which listed it before have time to finish; a stream that writes the folder
# only ever adds files and is not disturbed.


def expire_topics(
    spark: SparkSession, folders: dict[str, str], as_of: date | None = None, *, grace: timedelta = GRACE
) -> dict[str, list[str]]:
    """``expire_folder`` for the folder of each topic, by the topic's retention; a
    compacted topic is left alone. Returns the deleted folders per topic."""
    return {
        topic: expire_folder(spark, folder, RETENTION_DAYS[topic], as_of, grace=grace)
        for topic, folder in folders.items()
        if RETENTION_DAYS[topic] is not None
    }


def expire_folder(
    spark: SparkSession,
    path: str,
    days: int,
    as_of: date | None = None,
    *,
    grace: timedelta = GRACE,
    day_col: str = "dt",
) -> list[str]:
    """Hide the day folders older than ``days``, delete those hidden for ``grace``.

    Day folders may lie below others, as those of topics or batches. The bound is an
    empty file named by it; ``live`` applies the newest one to whatever a reader lists.
    A late row may still come into an expired day; it is hidden like the rest and goes
    with the next call. Returns the deleted folders. Only names of folders reach the
    driver.
    """
    today = as_of or datetime.now(timezone.utc).date()
    bound = (today - timedelta(days=_check_days(days))).isoformat()
    files, root = file_system(spark, path)
    if not files.exists(root):
        return []
    marks = _marks(spark, path)
    if bound > max(marks, default=""):
        touch(spark, f"{path}/{_EXPIRED}/{_MARK}{bound}")
        marks = _marks(spark, path)
    until = datetime.now(timezone.utc) - grace
    ripe = max((day for day, since in marks.items() if since <= until), default="")
    new_path, base, gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, files.makeQualified(root).toString(), []
    for above in ("", "*/", "*/*/"):
        for found in files.globStatus(new_path(f"{path}/{above}{day_col}=*")) or []:
            folder = found.getPath()
            inside = folder.toString()[len(base) :].strip("/")
            day = folder.getName().removeprefix(f"{day_col}=")
            if len(day) == 10 and day < ripe and not inside.startswith(STAGING):
                files.delete(folder, True)
                gone.append(inside)
    for day in children(spark, f"{path}/{MERGED}"):
        if len(day) == 10 and day < ripe:
            delete(spark, f"{path}/{MERGED}/{day}")
    for day in marks:
        if day < ripe:
            delete(spark, f"{path}/{_EXPIRED}/{_MARK}{day}")
    return sorted(gone)


def _marks(spark: SparkSession, path: str) -> dict[str, datetime]:
    """The bounds set so far, with the time each was set."""
    files, where = file_system(spark, f"{path}/{_EXPIRED}")
    if not files.exists(where):
        return {}
    return {
        s.getPath().getName().removeprefix(_MARK): datetime.fromtimestamp(s.getModificationTime() / 1000, timezone.utc)
        for s in files.listStatus(where)
        if s.getPath().getName().startswith(_MARK)
    }


def expired_before(spark: SparkSession, path: str) -> str | None:
    """The day before which everything in a folder is expired, if it was ever set."""
    return max(_marks(spark, path), default=None)


def live(
    spark: SparkSession, df: DataFrame, path: str, *, day_col: str = "dt", where: Column | None = None
) -> DataFrame:
    """The rows of ``df``, read from ``path``, that are not expired; whole folders are
    pruned, so those about to be deleted are not opened. ``where`` limits the bound to
    some rows. Rows without a day are never expired."""
    bound = expired_before(spark, path)
    if bound is None:
        return df
    kept = F.col(day_col).isNull() | (F.col(day_col) >= F.lit(bound).cast("date"))
    return df.where(kept if where is None else kept | ~where)


def drop_expired_partitions(
    spark: SparkSession, table: str, days: int, as_of: date | None = None, *, day_col: str = "dt"
) -> list[str]:
    """Drop the day partitions older than ``days``; returns the dropped days.

    The files of an external table go as well: dropping its partition would leave
    them, and the next discovery would bring the day back. A view, such as a gold
    table's, is refused; expire its input and refresh it. Only partition names reach
    the driver, one per stored day.
    """
    today = as_of or datetime.now(timezone.utc).date()
    oldest = (today - timedelta(days=_check_days(days))).isoformat()
    kind = spark.catalog.getTable(table).tableType
    if kind in ("VIEW", "TEMPORARY"):
        raise ValueError(f"{table} is a view; expire the table it is built from and refresh it")
    names = (row["partition"] for row in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator())
    stored = sorted({name.split(f"{day_col}=", 1)[1].split("/", 1)[0] for name in names})
    expired = [day for day in stored if day < oldest]
    if expired and kind == "EXTERNAL":
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
        location = described.first()["data_type"].rstrip("/")
    for day in expired:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({day_col} = '{day}')")
        if kind == "EXTERNAL":
            delete(spark, f"{location}/{day_col}={day}")
    return expired
