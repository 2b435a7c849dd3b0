"""Appending micro-batches to a folder of plain parquet files.

Spark's own file sink keeps a log beside its files, and whoever reads the folder must
follow that log: catalog tables and other engines can't, and no file may ever go. Here
a folder has nothing but dated files, and a batch gets into it exactly once:

1. the batch is written below ``_staging``, which readers don't see;
2. once that is complete (``_SUCCESS``), its files are renamed one by one into their
   folders, under names that tell the stream and the batch;
3. ``_done`` says that all of them are there, and what was staged goes.

A batch that is run again after a failure goes on where it broke off: before 2 nothing
was to be seen and it is written anew, after 2 the rest is renamed, after 3 nothing is
added. Published files are never rewritten or taken back. The file system must
rename files atomically and see them at once, as HDFS and local disks do.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

STAGING, DONE, MERGED = "_staging", "_done", "_merged"


def file_system(spark: SparkSession, folder: str):
    """The file system of a path wherever it lies, and the path as one of its own."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    files, where = file_system(spark, path)
    return files.exists(where)


def touch(spark: SparkSession, path: str) -> None:
    files, where = file_system(spark, path)
    files.create(where, True).close()


def delete(spark: SparkSession, path: str) -> None:
    files, where = file_system(spark, path)
    files.delete(where, True)


def children(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, none if it is not there."""
    files, where = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint belongs to: another start, the same stream;
    another checkpoint, another stream, whatever its batches are numbered."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"].replace("-", "")[:12]


def publish_batch(rows: DataFrame, path: str, stream: str, batch_id: int, partition_by: list[str]) -> None:
    """Append one batch of a stream to the folder, once however often it is called.

    Only names of files pass the driver, some for each folder that the batch touches.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    stage, done = f"{path}/{STAGING}/{stream}-{batch_id}", f"{path}/{DONE}/{stream}-{batch_id}"
    written, ended = exists(spark, f"{stage}/_SUCCESS"), exists(spark, done)
    if written or ended:
        # The state behind the batch was not committed with it, so it is computed again.
        rows.write.format("noop").mode("overwrite").save()
    if ended:
        return
    if not written:
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(stage)
    move_files(spark, stage, path, f"{stream}-{batch_id:010d}-")
    touch(spark, done)
    delete(spark, stage)
    for old in children(spark, f"{path}/{DONE}"):
        name, _, number = old.rpartition("-")
        # The newest batch may come again; those before it never do.
        if name == stream and int(number) < batch_id:
            delete(spark, f"{path}/{DONE}/{old}")


def move_files(spark: SparkSession, stage: str, path: str, prefix: str) -> list[str]:
    """Rename the data files below ``stage`` into the same folders below ``path``; what
    was renamed before stays. Returns the new names, relative to ``path``."""
    files, source = file_system(spark, stage)
    new_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root, found, moved = files.makeQualified(source).toString(), [], []
    listed = files.listFiles(source, True)
    while listed.hasNext():
        found.append(listed.next().getPath())
    for file in found:
        if file.getName().startswith(("_", ".")):
            continue
        folder = file.getParent().toString()[len(root) :].strip("/")
        target = new_path(f"{path}/{folder}" if folder else path, prefix + file.getName())
        files.mkdirs(target.getParent())
        if not files.rename(file, target):
            raise OSError(f"{file.toString()} could not be renamed to {target.toString()}")
        moved.append(f"{folder}/{target.getName()}".strip("/"))
    return moved


def data_files(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """Length and time of every data file below ``path``, by relative name; hidden folders
    are left out. As many names as Spark itself lists to scan the folder."""
    files, root = file_system(spark, path)
    found: dict[str, tuple[int, int]] = {}
    if not files.exists(root):
        return found
    base, listed = files.makeQualified(root).toString(), files.listFiles(root, True)
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().toString()[len(base) :].strip("/")
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            found[name] = (status.getLen(), status.getModificationTime())
    return found
