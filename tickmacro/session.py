"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(app: str = "tickmacro", conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every job here relies on.

    The master, memory and shuffle width are left to spark-submit or ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Up to this many newest rows a ranked group is cut before the shuffle.
        .config("spark.sql.optimizer.windowGroupLimitThreshold", "10000")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Days, minutes and windows are UTC; the session zone decides all three."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, else one in the warehouse.

    The cluster names the first, so it is taken as it is. A warehouse on the disk of one
    machine, Spark's default, will do for a local master only; elsewhere it is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    one_machine = urlparse(base).scheme in ("", "file")
    if one_machine and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors see; {base} is on one machine")
    return base + "/_work"


def new_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
