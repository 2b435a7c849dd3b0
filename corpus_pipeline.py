"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding.

Every stage takes the rows its predecessor kept; all but the last return the columns
of ``documents``, the last adds ``shard``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickmacro.llm import decontaminate, mixing, near_copies, quality, sharding
from tickmacro.llm.common import staged
from tickmacro.llm.queries import SHARDS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified cutoff reject go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id.

    Near copies are linked by SimHash, as op9 does, or have four fifths or more of all their
    five-word shingles in common, which most such pairs show in no two bits.
    """
    return near_copies.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, items).where("n_hit = 0").select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row with the shard it belongs to."""
    return sharding.assign(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix", mix),
    ("shard", shard),
]

#: Shingles are XXH64 hashes and groups are components, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
