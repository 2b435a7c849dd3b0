"""Registered text queries over the given tables: SQL where there is one, else brute force."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.compare import compare, connect
from tests.llm import brute
from tests.llm.test_near_copies import one_of_each_group
from tickmacro.llm import secret_scan
from tickmacro.llm.oracles import LLM_ORACLES
from tickmacro.llm.queries import LLM_QUERIES


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())


def _by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_all_operators_and_the_pipeline_are_registered():
    names = contract.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(LLM_ORACLES) < set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(LLM_QUERIES[name](spark, sf_dir), connect(sf_dir), LLM_ORACLES[name]) > 0


def test_sentence_dedup_equals_brute_force(spark, sf_dir, documents):
    found = _by_id(LLM_QUERIES["op2_sentence_dedup"](spark, sf_dir))
    for doc_id, text, gone in brute.repeated_sentences(documents):
        removed = [tuple(map(int, s.split(":"))) for s in found[doc_id].removed.split(",") if s]
        assert {k for s, e in removed for k in range(s, e)} == gone
        assert found[doc_id].text == "".join(c for k, c in enumerate(text) if k not in gone)
        # What goes begins and ends between sentences, but within long ones.
        ends = {0, *brute.sentence_ends(text)}
        inside = [e for pair in removed for e in pair if e not in ends]
        assert all(brute.words_around(text, e) > 14 for e in inside)


def test_simhash_equals_brute_force(spark, sf_dir, documents):
    found = _by_id(LLM_QUERIES["op9_simhash"](spark, sf_dir))
    prints = [brute.fingerprint(text) for _, text in documents]
    for (doc_id, _), p, root in zip(documents, prints, brute.groups(prints)):
        assert (found[doc_id].fingerprint, found[doc_id].component_id) == (f"{p:016x}", documents[root][0])


def test_model_equals_brute_force_and_beats_counts(spark, sf_dir, documents):
    found = _by_id(LLM_QUERIES["op10_maxent"](spark, sf_dir))
    for (doc_id, _), want in zip(documents, brute.unigrams(documents)):
        r = found[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[:4]
        assert r.base_score == pytest.approx(want[4], rel=1e-9)
    held = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_samples_label_themselves(spark, sf_dir):
    scanned = secret_scan.scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert secret_scan.labelled(scanned).columns == ["token", "random"]


def test_the_pipeline_takes_empty_and_odd_tables(spark, sf_dir, tmp_path, odd, empty):
    for name, docs in {"odd": odd, "empty": empty}.items():
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        for table in ("labels", "benchmark"):
            spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(f"{tmp_path}/{name}/{table}.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert [c for c in out.columns if c != "shard"] == [c for c in odd.columns if c != "shard"]
        assert (out.count() > 0) == (name == "odd")


def test_stages_do_what_their_operators_say(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, rows = docs.columns, {0: docs}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.staged(stage(spark, docs, sf_dir), name)
        rows[k + 1] = docs
        assert docs.columns[: len(columns)] == columns and docs.count() > 0
    quality, dedup, clean, mixed, sharded = (rows[k].select("doc_id", "text").collect() for k in range(1, 6))
    assert not any(brute.quality(r.text)[5] for r in quality)
    assert sorted(r.doc_id for r in dedup) == one_of_each_group([tuple(r) for r in quality])
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    hits = brute.contamination([r.text for r in dedup], items)
    assert {r.doc_id for r in clean} == {r.doc_id for r, h in zip(dedup, hits) if not h[4]}
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in clean} and max(
        sum(x.doc_id == r.doc_id for x in mixed) for r in mixed
    ) <= 3
    assert sorted(r.doc_id for r in sharded) == sorted(r.doc_id for r in mixed)
    assert rows[5].columns == [*columns, "shard"]
