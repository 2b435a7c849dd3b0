"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tickmacro.llm.common import packed, staged
from tickmacro.llm.components import components

#: Shingles whose bits are unpacked at once; bounds the memory of a long text.
_CHUNK = 1 << 15


def simhash(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a UTF-8 text as a signed number; zero without a word."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    runs = zip(*(tokens[i:] for i in range(shingle))) if len(tokens) >= shingle else [tokens]
    hashes = np.fromiter((xxh64_intdigest(b" ".join(run), seed) for run in runs), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(
    docs: DataFrame, text: str = "text", shingle: int = 3, keep: list[str] | None = None
) -> DataFrame:
    """``docs`` as (row, rid, fp): the row, a number for it, its fingerprint.

    ``keep`` names the columns of ``row``, all of them by default. Staged, as the
    pass over the texts is the costly part and ``rid`` must hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = pa.array([simhash(t.as_py(), shingle) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["row", "fp"])

    rows = packed(docs, keep or docs.columns, text=docs[f"`{text}`"].cast("string"))
    schema = rows.select("row", F.lit(0).cast("long").alias("fp")).schema
    out = rows.mapInArrow(run, schema)
    return staged(out.withColumn("rid", F.monotonically_increasing_id()), "simhash")


def block_masks(distance: int, blocks: int) -> list[int]:
    """Bit masks of every choice of ``blocks - distance`` of the blocks of 64 bits.

    Two fingerprints that differ in at most ``distance`` bits leave that many
    blocks untouched, so they agree under one of the masks at least.
    """
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def links(distinct: DataFrame, distance: int = 2, blocks: int = 5, pair_limit: int = 64) -> DataFrame:
    """Links (a, b) that connect all ``distinct`` fingerprints (fp) within ``distance``.

    With five blocks and distance two a key has 38 bits or more, so chance
    neighbours stay few at billions of fingerprints. Keys with one fingerprint
    are dropped before the join. Keys with up to ``pair_limit`` fingerprints are
    joined with themselves and verified. Keys with more, where pairs would grow
    with the square, are linked through what lies between: two fingerprints within
    an even distance d share a value at distance d / 2 from both, and all that share
    one are within d of each other. A value is shared by few fingerprints, so each
    is linked to the smallest; the components are those of all pairs.
    """
    if distance % 2:
        raise ValueError("distance must be even")
    masks = block_masks(distance, blocks)
    keyed = distinct.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("block", "key")
    )
    shared = keyed.groupBy("block", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = staged(keyed.join(shared, ["block", "key"]), "blocks")
    few = shared.where(F.col("n") <= pair_limit)
    left = few.select("block", "key", F.col("fp").alias("a"))
    right = few.select("block", "key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = left.join(right, ["block", "key"]).where(F.col("a") < F.col("b")).where(near)
    many = shared.where(F.col("n") > pair_limit)
    free = F.array(*[F.lit(_signed(~m & ((1 << 64) - 1))) for m in masks])
    flips = [0]
    between = many.select("fp", "block", "key", F.element_at(free, F.col("block") + 1).alias("free"))
    for r in range(1, distance // 2 + 1):
        flips += [sum(1 << b for b in chosen) for chosen in combinations(range(64), r)]
    flips = F.array(*[F.lit(_signed(x)) for x in flips])
    between = between.select(
        "fp", "block", "key", F.explode(F.filter(flips, lambda x: x.bitwiseAND(F.col("free")) == x)).alias("flip")
    ).select("fp", "block", "key", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    stars = between.groupBy("block", "key", "value").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all"))
    stars = stars.where(F.size("all") > 1).select("a", F.explode("all").alias("b"))
    stars = stars.where(F.col("a") != F.col("b")).where(near)
    return pairs.select("a", "b").union(stars).distinct()


def groups(marked: DataFrame, distance: int = 2) -> DataFrame:
    """(fp, root) for every fingerprint: all that links connect have one root.

    Exact copies are one fingerprint before anything is linked.
    """
    distinct = staged(marked.select("fp").distinct(), "fps")
    roots = components(links(distinct, distance)).withColumnRenamed("node", "fp")
    joined = distinct.join(roots, "fp", "left")
    return joined.select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(marked: DataFrame, doc_id: str = "doc_id", distance: int = 2) -> DataFrame:
    """``fingerprints`` output with ``component_id``, the smallest id of its group.

    Every row is kept, repeated rows too. Rows with a null id take part and get the
    smallest id of the others, null if there is none. Texts without a word have
    fingerprint zero and are linked like any other.
    """
    ids = marked.select("fp", F.col(f"row.`{doc_id}`").alias("id"))
    least = ids.groupBy("fp").agg(F.min("id").alias("id"))
    least = staged(least.join(groups(marked, distance), "fp"), "roots")
    whole = least.groupBy("root").agg(F.min("id").alias("component_id"))
    return marked.join(least.select("fp", "root").join(whole, "root").drop("root"), "fp")


def drop_near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """One row of each group of ``docs`` stays: that of the smallest id.

    Nulls come last, and of rows with one id the first read stays. Columns are kept.
    """
    marked = fingerprints(docs, text, shingle)
    order = F.struct(F.col(f"row.`{doc_id}`").isNull(), F.col(f"row.`{doc_id}`"), F.col("rid"))
    first = marked.groupBy("fp").agg(F.min(order).alias("first"))
    first = first.join(groups(marked, distance), "fp")
    kept = first.groupBy("root").agg(F.min("first.rid").alias("rid"), F.min("first").alias("first"))
    kept = staged(kept.select(F.col("first.rid").alias("rid")), "kept")
    # Both sides are dealt by row number at every size, the texts evenly.
    return marked.join(kept.hint("merge"), "rid").select("row.*")
