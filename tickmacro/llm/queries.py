"""One query for each text operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmacro.llm import (
    decontaminate,
    fill_middle,
    main_text,
    maxent,
    mixing,
    pii,
    quality,
    secret_scan,
    sentence_dedup,
    sharding,
    simhash,
    url_filter,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _of_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[_of_kind("base", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secret_scan.digest(F.col("base")), 256).alias("base_sha256"),
        secret_scan.digest(F.col("spans")).alias("spans"),
    )


def op2_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = sentence_dedup.dedup(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    cut = F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return clean.select(
        F.col("row.doc_id").alias("doc_id"),
        "text",
        "n_sentences",
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(cut, ",").alias("removed"),
    )


#: The rules for pages.
URL_RULES = [
    url_filter.Rule("com", "/", allow=True),
    url_filter.Rule("example.com", "/en/", allow=False),
    url_filter.Rule("www.example.com", "/en/", allow=True),
    url_filter.Rule("net", "/es/", allow=False),
    url_filter.Rule("net", "/fr/", allow=False),
]


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES, keep=["page_id"])
    return judged.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[_of_kind("base", kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")],
        F.sha2(pii.digest(F.col("base")), 256).alias("base_sha256"),
        pii.digest(F.col("spans")).alias("spans"),
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.decontaminate(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return judged.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: The shards of the production table.
SHARDS = [f"shard-{k:04d}" for k in range(256)]


def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id")
    placed = sharding.assign(docs, SHARDS)
    return placed.select("doc_id", sharding.slot_of(F.col("doc_id")).alias("slot"), "shard")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.measure(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    certified = quality.cutoffs(measured, _table(spark, sf_dir, "labels"))
    return quality.judge(measured, certified).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = mixing.sized(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixing.take(sizes).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.fingerprints(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return simhash.near_duplicates(marked).select(
        F.col("row.doc_id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op10_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = maxent.score_texts(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("held").alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(_table(spark, sf_dir, "embeddings"), keep=["vec_id"])
    return white.select(
        F.col("row.vec_id").alias("vec_id"),
        "component",
        "n",
        "deviation",
        "whitened",
        "explained",
        "identity_error",
    )


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_middle(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    again = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        F.col("row.doc_id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(again.cast("binary"), 256).alias("restored_sha256"),
    )


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text.extract(_table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.select("row.*", "text", F.length("text").cast("long").alias("n_chars"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_sentence_dedup": op2_sentence_dedup,
    "op3_urls": op3_urls,
    "op4_pii": op4_pii,
    "op5_decontaminate": op5_decontaminate,
    "op6_shard": op6_shard,
    "op7_quality": op7_quality,
    "op8_mix": op8_mix,
    "op9_simhash": op9_simhash,
    "op10_maxent": op10_maxent,
    "op11_whitening": op11_whitening,
    "op12_fill_middle": op12_fill_middle,
    "op13_main_text": op13_main_text,
}
