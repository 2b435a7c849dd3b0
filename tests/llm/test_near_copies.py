"""The near-dedup stage against Jaccard similarities of all pairs."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tickmacro.llm import near_copies, simhash
from tickmacro.llm.common import held


def runs(text):
    w = brute.words(brute.lower(text))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())


def one_of_each_group(rows):
    """The smallest ids of the groups of (id, text) that pairs of Jaccard 0.8 or more connect."""
    sets, root = [runs(text) for _, text in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a == sets[j] or both >= 0.8 * (len(a) + len(sets[j]) - both) > 0:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    groups = [find(i) for i in range(len(rows))]
    return sorted(min(rows[j][0] for j in range(len(rows)) if groups[j] == g) for g in set(groups))


def _ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stage_equals_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert _ids(corpus_pipeline.near_dedup(spark, docs, sf_dir)) == one_of_each_group(rows)


def test_planted_near_copies_equal_all_pairs(make_docs):
    rng, rows = random.Random(5), []
    for n in (12, 40, 90, 200):
        base = [rng.choice("abcdefgh") + str(rng.randrange(900)) for _ in range(n)]
        for changes in range(0, 12):
            words = list(base)
            for at in rng.sample(range(n), min(changes, n)):
                words[at] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    banner = " ".join(f"cookie{k}" for k in range(30))
    rows += [(len(rows) + k, banner + " " + " ".join(f"own{k}x{j}" for j in range(20))) for k in range(60)]
    large = [f"line{k}" for k in range(80)]
    for _ in range(80):
        words = list(large)
        words[rng.randrange(80)] = f"odd{rng.randrange(10**6)}"
        rows.append((len(rows), " ".join(words)))
    rows.append((len(rows), " ".join(large)))
    assert _ids(near_copies.drop_near_copies(make_docs(rows))) == one_of_each_group(rows)


def test_one_row_stays_and_columns_too(odd, empty):
    kept = near_copies.drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.select("doc_id").collect()) == [
        (False, 1), (False, 4), (False, 6), (False, 7), (False, 8), (True, None)
    ]
    assert near_copies.drop_near_copies(empty).count() == 0


def test_the_map_of_held_numbers_loses_none(spark):
    ids = spark.range(0, 90_000, 3).withColumnRenamed("id", "rid")
    test = held(ids)
    all_ = spark.range(0, 300_000).withColumn("in", test(F.col("id")))
    assert all_.where((F.col("id") < 90_000) & (F.col("id") % 3 == 0) & ~F.col("in")).isEmpty()
    assert all_.where("in").count() < 30_000 + 9_000
    assert spark.range(9).where(held(ids.where("false"))(F.col("id"))).isEmpty()


def test_the_held_numbers_are_in_no_text_of_a_plan(spark):
    """The driver keeps the texts of many plans, and a new one for each step of a query."""
    ids = spark.range(0, 90_000, 3).withColumnRenamed("id", "rid")
    rows = spark.range(0, 300).where(held(ids)(F.col("id")))
    assert rows.count() >= 100
    assert len(rows._jdf.queryExecution().toString()) < 50_000


def test_what_is_connected_goes_on_as_stars(spark, make_docs, monkeypatch):
    """Where the first comparisons connect a whole group, the second run of the rounds finds
    nothing to move."""
    words = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join(words[:k] + [f"odd{k}"] + words[k + 1 :])) for k in range(5, 75, 3)]
    rows.append((99, " ".join(words)))
    rounds, marks, components = [0], near_copies.components.__globals__["_mark"], near_copies.components

    def counting(links):
        rounds.append(0)
        return components(links)

    def counted(edges):
        rounds[-1] += 1
        return marks(edges)

    monkeypatch.setitem(components.__globals__, "_mark", counted)
    monkeypatch.setattr(near_copies, "components", counting)
    assert _ids(near_copies.drop_near_copies(make_docs(rows))) == one_of_each_group(rows)
    assert rounds[-1] == 2


def test_fine_maps_of_two_sizes_differ_in_no_more_than_the_sets(spark):
    rng, rows, differ = np.random.default_rng(3), [], []
    for n in (10, 1000, 1030, 4090, 5000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for changed in (0, 3, n // 10, n):
            b = np.unique(np.concatenate([a[changed:], rng.integers(0, 2**63, changed + n // 20).astype(np.uint64)]))
            rows.append((near_copies.fine_parity(a).tolist(), near_copies.fine_parity(b).tolist()))
            differ.append((len(np.setxor1d(a, b)), len(a) + len(b)))
    assert {len(x) != len(y) for x, y in rows} == {True, False}
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, a array<long>, b array<long>")
    for r in df.select("k", near_copies._fine(F.col("a"), F.col("b")).alias("bits")).collect():
        d, both = differ[r.k]
        assert r.bits <= d and (d < both or 9 * r.bits > both)


def test_the_order_of_shingles_decides_on_work_alone():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, 60).astype(np.uint64))
        b = np.unique(np.concatenate([a[3:], rng.integers(0, 2**63, 3).astype(np.uint64)]))
        common = np.sort(rng.choice(a, 20, replace=False))
        rank = rng.permutation(20)
        assert set(near_copies.prefix(a, common, rank)) & set(near_copies.prefix(b, common, rank))
        differ = len(set(a.tolist()) ^ set(b.tolist()))
        maps = (near_copies.parity(a) ^ near_copies.parity(b)).view(np.uint64)
        assert int(np.bitwise_count(maps).sum()) <= differ
        fine = (near_copies.parity(a, 32) ^ near_copies.parity(b, 32)).view(np.uint64)
        assert int(np.bitwise_count(fine).sum()) <= differ


def test_the_stage_links_what_simhash_links(spark, make_docs, sf_dir):
    """Texts whose fingerprints differ in two bits at most, with fewer shingles in common."""
    base = [f"w{k}" for k in range(60)]
    rng, found = random.Random(2), None
    of = lambda w: simhash.simhash(" ".join(w).encode()) & (2**64 - 1)
    for _ in range(4000):
        words = list(base)
        for at in (10, 30, 50):
            words[at] = f"new{rng.randrange(10**6)}"
        if (of(words) ^ of(base)).bit_count() <= 2:
            found = words
            break
    rows = [(1, " ".join(base)), (2, " ".join(found)), (3, " ".join(f"z{k}" for k in range(60)))]
    assert one_of_each_group(rows) == [1, 2, 3]
    assert _ids(corpus_pipeline.near_dedup(spark, make_docs(rows), sf_dir)) == [1, 3]


def test_shingles_are_staged_for_likely_pairs_alone(spark, make_docs, monkeypatch):
    """Long texts that share a passage meet, but their sets are not written."""
    rng = random.Random(7)
    shared = " ".join(f"s{k}" for k in range(60))
    rows = [(k, shared + " " + " ".join(f"o{k}x{rng.randrange(10**6)}" for _ in range(1500))) for k in range(12)]
    rows += [(20, "a b c d e f g h i j k l m n o p q r s t u v w x y"), (21, "a b c d e f g h i j k l m n o p q r s t u v w x z")]
    written, staged = {"pair_sets": 0, "maps": 0}, near_copies.staged

    def counting(df, name):
        out = staged(df, name)
        if name in written:
            written[name] += out.count()
        return out

    monkeypatch.setattr(near_copies, "staged", counting)
    assert _ids(near_copies.drop_near_copies(make_docs(rows))) == one_of_each_group(rows)
    assert written["pair_sets"] <= 4
