"""Near copies: op9's SimHash links, and by exact Jaccard similarity of word shingles what
SimHash does not reach, by a prefix join; no sketch rules a pair out.

Two sets with a similarity of ``SIMILARITY`` or more share one of the first
``n - ceil(SIMILARITY * n) + 1`` shingles of each in any order that all sets follow. The
order here is by hash, with shingles that a part of the texts shows to be common at its
end; so that part decides on the work alone, never on the pairs that are found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tickmacro.llm import simhash
from tickmacro.llm.common import held, packed, scratch, staged
from tickmacro.llm.components import components

#: Similarity 4 / 5: numbers of shingles are compared as integers.
SHARE, WHOLE = 4, 5

#: Words of 64 bits in the parity map of a set, and at least in that of a set that has a candidate.
_MAP, _FINE = 8, 32


def shingles(text: bytes | None, shingle: int = 5) -> np.ndarray:
    """The sorted hashes of the distinct runs of ``shingle`` words; a shorter text is one run."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    runs = zip(*(tokens[i:] for i in range(shingle))) if len(tokens) >= shingle else [tokens]
    return np.unique(np.fromiter((xxh64_intdigest(b" ".join(run), 42) for run in runs), np.uint64))


def prefix(hashes: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The shingles of a set under which it meets every set that is similar to it.

    ``common`` is sorted; ``rank`` has its places in the order, after all other hashes.
    """
    n = len(hashes)
    size = n - -(-SHARE * n // WHOLE) + 1 if n else 0
    late = np.zeros(n, np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        late = np.where(common[at] == hashes, rank[at] + 1, 0)
    return hashes[np.argsort(late, kind="stable")[:size]]


def parity(hashes: np.ndarray, words: int = _MAP) -> np.ndarray:
    """One bit for each class of hashes: whether the set has an odd number of it.

    Maps of two sets differ in no more bits than the sets differ in shingles.
    """
    odd = np.bincount((hashes % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def fine_parity(hashes: np.ndarray) -> np.ndarray:
    """The parity map of a set that has a candidate, with two bits or more for each shingle:
    with fewer, even sets without a common shingle could differ in too few to be told."""
    words = _FINE
    while 64 * words < 2 * len(hashes):
        words *= 2
    return parity(hashes, words)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate([np.empty(0, np.int64), *[v.view(np.int64) for v in values]])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _sets(rows: DataFrame, shingle: int) -> DataFrame:
    """(rid, text) to (rid, hashes): the shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py(), shingle) for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(found)], ["rid", "hashes"])

    return rows.mapInArrow(run, "rid long, hashes array<long>")


def _maps(rows: DataFrame, shingle: int) -> DataFrame:
    """(rid, text) to (rid, n, map): the number of shingles and their fine parity map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py(), shingle) for t in batch.column(1).cast(pa.binary())]
            sizes = pa.array([len(s) for s in found], pa.int64())
            maps = _lists([fine_parity(s) for s in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, maps], ["rid", "n", "map"])

    return rows.mapInArrow(run, "rid long, n long, map array<long>")


def common_shingles(rows: DataFrame, shingle: int = 5, every: int = 8, least: int = 8, most: int = 1 << 16) -> np.ndarray:
    """Frequent shingles of every eighth text, the least frequent first."""
    some = _sets(rows.where(F.pmod("rid", F.lit(every)) == 0), shingle)
    counts = some.select(F.explode("hashes").alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    found = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "h").limit(most).toArrow()
    return found.column("h").to_numpy().view(np.uint64)[::-1].copy()


def marked_sets(rows: DataFrame, common: np.ndarray, shingle: int = 5) -> DataFrame:
    """(rid, text) to (rid, h1, h2, n, map, keys), staged: hash, size, parity map and prefix."""
    order = np.argsort(common)
    sorted_common, rank = common[order], order.astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), shingle) for t in batch.column(1).cast(pa.binary())]
            halves = np.frombuffer(b"".join(md5(s.tobytes()).digest() for s in sets), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.ascontiguousarray(halves[:, 0])),
                    pa.array(np.ascontiguousarray(halves[:, 1])),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _lists([parity(s) for s in sets]),
                    _lists([prefix(s, sorted_common, rank) for s in sets]),
                ],
                ["rid", "h1", "h2", "n", "map", "keys"],
            )

    return staged(
        rows.mapInArrow(run, "rid long, h1 long, h2 long, n long, map array<long>, keys array<long>"), "sets"
    )


def _coarse(a: Column, b: Column) -> Column:
    """In how many bits two parity maps of ``_MAP`` words differ."""
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(_MAP)), F.lit(0))


def _fine(a: Column, b: Column) -> Column:
    """The same of two fine maps. Sizes are powers of two; the halves of the larger are
    laid over each other, as the classes of the smaller are those of its own together."""
    size = F.least(F.size(a), F.size(b))
    xor = lambda x, y: x.bitwiseXOR(y)
    folded = lambda m: F.when(F.size(m) > size, F.zip_with(F.slice(m, 1, size), F.slice(m, size + 1, size), xor)).otherwise(m)
    return F.aggregate(F.zip_with(folded(a), folded(b), xor), F.lit(0), lambda acc, x: acc + F.bit_count(x))


def _may(a: str, b: str, differ: Callable[[Column, Column], Column] = _coarse) -> Column:
    """False only for sets that cannot be similar: by their sizes or by their parity maps."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = (WHOLE * na >= SHARE * nb) & (WHOLE * nb >= SHARE * na)
    near = differ(F.col(f"{a}.map"), F.col(f"{b}.map")) * (WHOLE + SHARE) <= (na + nb) * (WHOLE - SHARE)
    return F.when(sizes, near).otherwise(False)


def verified(pairs: DataFrame, rows: DataFrame, shingle: int = 5) -> DataFrame:
    """The ``pairs`` (a, b) of similar sets, by the shingles of their texts.

    Texts without a pair are left out where they are read, so no text is shuffled. Fine
    parity maps, far smaller than the sets, rule out most pairs first, and only the texts
    of the others are read once more for their shingles.
    """
    with scratch(rows.sparkSession, keep=("similar",)):
        about = staged(_maps(_of(pairs, rows), shingle), "maps").select("rid", F.struct("n", "map").alias("x"))
        pairs = pairs.join(about.select(F.col("rid").alias("b"), F.col("x").alias("y")), "b")
        pairs = pairs.join(about.withColumnRenamed("rid", "a"), "a").where(_may("x", "y", _fine))
        pairs = staged(pairs.select("a", "b"), "likely")
        sets = staged(_sets(_of(pairs, rows), shingle), "pair_sets")
        one = sets.select(F.col("rid").alias("a"), F.col("hashes").alias("left"))
        two = sets.select(F.col("rid").alias("b"), F.col("hashes").alias("right"))
        both = F.size(F.array_intersect("left", "right"))
        similar = (WHOLE + SHARE) * both >= SHARE * (F.size("left") + F.size("right"))
        # A leader has many pairs; the other side is met first, so that the pairs of one leader can be split.
        return staged(pairs.join(two, "b").join(one, "a").where(similar).select("a", "b"), "similar")


def _of(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The ``rows`` that are in ``pairs``, and few others."""
    paired = held(pairs.select(F.explode(F.array("a", "b")).alias("rid")))
    return rows.where(paired(F.col("rid")))


def fingerprint_links(texts: DataFrame, marked: DataFrame, copies: DataFrame) -> DataFrame:
    """Links (a, b) of the ``copies`` that SimHash, as op9 runs it, has in one group: from
    the smallest of each group to the others."""
    found = simhash.fingerprints(texts, keep=["rid"])
    found = found.select("row.rid", "fp").join(simhash.groups(found), "fp").select("rid", "root")
    reps = marked.select("rid", "h1", "h2").join(copies, ["h1", "h2"]).select("rid", "rep")
    grouped = staged(found.join(reps, "rid").select("root", "rep").distinct(), "fingerprinted")
    least = grouped.groupBy("root").agg(F.min("rep").alias("a"))
    return staged(grouped.join(least, "root").where("a <> rep").select("a", F.col("rep").alias("b")), "alike")


def links(sets: DataFrame, rows: DataFrame, alike: DataFrame, shingle: int = 5) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of similar ``sets`` and of ``alike``.

    Sets that share a key of their prefixes are candidates. Each is first compared
    with two leaders of its block, the member of the most blocks and one by chance,
    the same in all blocks of one group.
    What these links and ``alike`` connect needs no further comparison: a large group of near copies
    takes links by its number, not by its square. All other pairs of a block are
    compared afterwards, whatever the size of the block.
    """
    keyed = sets.select("rid", F.explode("keys").alias("key"))
    twice = keyed.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    shared = staged(keyed.join(staged(twice, "twice"), "key"), "blocks")
    often = shared.groupBy("rid").agg(F.count("*").alias("w"))
    chance = F.struct(F.xxhash64("rid"), F.col("rid").alias("rid"))
    lead = shared.join(often, "rid").groupBy("key").agg(
        F.max(F.struct("w", F.col("rid").alias("rid")))["rid"].alias("l1"), F.min(chance)["rid"].alias("l2")
    )
    pairs = shared.join(lead, "key").select("rid", F.explode(F.array("l1", "l2")).alias("lead"))
    pairs = pairs.where("rid <> lead").select(F.col("lead").alias("a"), F.col("rid").alias("b")).distinct()
    about = sets.select("rid", F.struct("n", "map").alias("x"))
    pairs = pairs.join(about.select(F.col("rid").alias("b"), F.col("x").alias("y")), "b")
    pairs = pairs.join(about.withColumnRenamed("rid", "a"), "a").where(_may("x", "y")).select("a", "b")
    led = verified(staged(pairs, "led"), rows, shingle).union(alike)
    roots = components(led)
    rest = shared.join(roots.withColumnRenamed("node", "rid"), "rid", "left")
    rest = staged(rest.select("key", "rid", F.coalesce("root", "rid").alias("root")), "rest")
    mixed = rest.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    rest = rest.join(mixed.where("lo <> hi").select("key"), "key").join(about, "rid")
    one = rest.select("key", F.col("rid").alias("a"), F.col("root").alias("ra"), "x")
    two = rest.select("key", F.col("rid").alias("b"), F.col("root").alias("rb"), F.col("x").alias("y"))
    others = one.join(two, (one["key"] == two["key"]) & (F.col("ra") < F.col("rb")) & _may("x", "y"))
    others = staged(others.select("a", "b").distinct(), "others")
    # What is known to be connected goes on as stars, which need no second run of all rounds.
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return stars if others.isEmpty() else stars.union(verified(others, rows, shingle))


def drop_near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 5) -> DataFrame:
    """One row of each group of ``docs`` that links connect stays, that of the smallest id.

    Linked are texts whose SimHash fingerprints differ in two bits or fewer, as op9 links
    them, and those that have four fifths or more of all their shingles in common. Null
    ids come last, and of rows with one id the first read stays. Columns are kept.
    """
    rows = packed(docs, docs.columns, text=docs[f"`{text}`"].cast("string"), id=docs[f"`{doc_id}`"])
    rows = rows.select("row", "id", F.monotonically_increasing_id().alias("rid"), "text")
    whole = staged(rows.drop("text"), "numbered")
    texts = whole.select("rid", F.col(f"row.`{text}`").cast("string").alias("text"))
    with scratch(docs.sparkSession, keep=("kept", "gone")):
        marked = marked_sets(texts, common_shingles(texts, shingle), shingle)
        copies = staged(marked.groupBy("h1", "h2").agg(F.min("rid").alias("rep")), "copies")
        sets = marked.where("n > 0").join(copies.select(F.col("rep").alias("rid")), "rid")
        alike = fingerprint_links(texts, marked, copies)
        roots = staged(components(links(sets, texts, alike, shingle)).withColumnRenamed("node", "rep"), "roots")
        order = F.struct(F.col("id").isNull(), F.col("id"), F.col("rid"))
        first = marked.select("rid", "h1", "h2").join(whole.select("rid", "id"), "rid")
        first = first.groupBy("h1", "h2").agg(F.min(order).alias("first")).join(copies, ["h1", "h2"])
        first = first.join(roots, "rep", "left").groupBy(F.coalesce("root", "rep")).agg(F.min("first").alias("first"))
        kept = staged(first.select(F.col("first.rid").alias("rid")), "kept")
        gone = staged(whole.select("rid").join(kept.hint("merge"), "rid", "left_anti"), "gone")
    # Rows that are surely kept stay where they are; the others are dealt by row number.
    maybe = held(gone)(F.col("rid"))
    some = whole.where(maybe).join(gone.hint("merge"), "rid", "left_anti")
    return whole.where(~maybe).unionByName(some).select("row.*")
