"""Benchmark decontamination: prefix-filtered join on rare shingles, then exact windows."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickmacro.llm.common import packed, staged

#: Words are 0-9, a-z after lower-casing A-Z, and all beyond ASCII.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
#: Size of the filter that tasks hold: 4 MB, whatever the number of items.
_FILTER_BITS = 25
_MIX = np.uint64(0x9E3779B97F4A7C15)


def split_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


def shingle_hashes(tokens: list[bytes], size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` tokens."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(crc32, tokens), np.uint64, len(tokens))
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out = (out ^ each[j : j + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _slots(hashes: np.ndarray) -> np.ndarray:
    return hashes & np.uint64((1 << _FILTER_BITS) - 1)


def item_shingles(items: DataFrame, window: int, shingle: int, item_id: str, text: str) -> DataFrame:
    """(item, win, size, p, h): every shingle of every item window.

    ``win`` is the window's text, ``size`` its words, ``p`` where the shingle with
    hash ``h`` begins in it. Items without a word have no window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, value in enumerate(batch.column(1).cast(pa.binary())):
                tokens = split_words(value.as_py())
                if not tokens:
                    continue
                size = min(window, len(tokens))
                inner = min(shingle, size)
                hashes = shingle_hashes(tokens, inner).view(np.int64)
                starts = np.repeat(np.arange(len(tokens) - size + 1), size - inner + 1)
                offsets = np.tile(np.arange(size - inner + 1), len(tokens) - size + 1)
                texts = [b" ".join(tokens[i : i + size]).decode() for i in range(len(tokens) - size + 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[at].as_py()] * len(starts), pa.string()),
                        pa.array([texts[i] for i in starts], pa.string()),
                        pa.array(np.full(len(starts), size), pa.int32()),
                        pa.array(offsets, pa.int32()),
                        pa.array(hashes[starts + offsets]),
                    ],
                    ["item", "win", "size", "p", "h"],
                )

    named = items.select(items[f"`{item_id}`"].cast("string").alias("i"), items[f"`{text}`"].cast("string").alias("t"))
    out = named.mapInArrow(run, "item string, win string, size int, p int, h long")
    return staged(out, "shingles")


def _filter(tokens: DataFrame) -> np.ndarray:
    """One bit for each slot that a shingle of an item falls in."""
    slot = F.col("h").bitwiseAND((1 << _FILTER_BITS) - 1)
    bits = tokens.groupBy(F.shiftright(slot, 5).alias("i")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h & 31 as int))")).alias("bits")
    )
    out = np.zeros(1 << (_FILTER_BITS - 5), np.uint32)
    for row in bits.toLocalIterator():
        out[row["i"]] = row["bits"]
    return out


def scan(docs: DataFrame, tokens: DataFrame, text: str, keep: list[str], window: int, shingle: int) -> DataFrame:
    """(row, rid, n_words, pos, h, size, first, near): a row for each document, its
    ``pos`` null, and one for each shingle that may be an item's, its ``row`` null.

    ``near`` has the words around it that any window with it can reach, from word
    number ``first``. The filter has a fixed size; more items only make it let more
    shingles through, which the join then drops.
    """
    lengths = sorted(r[0] for r in tokens.select(F.least(F.lit(shingle), "size")).distinct().toLocalIterator())
    held = docs.sparkSession.sparkContext.broadcast(_filter(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for at, value in enumerate(batch.column(2).cast(pa.binary())):
                tokens_ = split_words(value.as_py())
                rows = [(len(tokens_), None, None, None, None, None)]
                for size in lengths:
                    hashes = shingle_hashes(tokens_, size)
                    slots = _slots(hashes)
                    on = bits[slots >> np.uint64(5)] >> (slots & np.uint64(31)).astype(np.uint32) & np.uint32(1)
                    for pos in np.flatnonzero(on).tolist():
                        first = max(0, pos - window + size)
                        near = b" ".join(tokens_[first : pos + window]).decode()
                        rows.append((None, pos, int(hashes[pos].view(np.int64)), size, first, near))
                for row in rows:
                    out[0].append(at)
                    for column, cell in zip(out[1:], row):
                        column.append(cell)
            index = pa.array(out[0], pa.int64())
            whole = pa.array([at if n is not None else None for at, n in zip(out[0], out[1])], pa.int64())
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.string())
            arrays = [batch.column(0).take(whole), batch.column(1).take(index)]
            arrays += [pa.array(column, kind) for column, kind in zip(out[1:], kinds)]
            names = ["row", "rid", "n_words", "pos", "h", "size", "first", "near"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = packed(docs, keep, rid=F.monotonically_increasing_id(), text=docs[f"`{text}`"].cast("string"))
    row_type = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(
        run, f"row {row_type}, rid long, n_words int, pos int, h long, size int, first int, near string"
    )
    return staged(out, "scan")


def occurrences(scanned: DataFrame, tokens: DataFrame) -> DataFrame:
    """(rid, start, size, item): where windows of items occur, as the texts themselves say.

    A window occurs only where all its shingles do, so one of them is a sufficient
    prefix: the one rarest among the documents. A window whose rarest shingle does
    not occur is dropped here. What joins must leave room for the whole window
    before and after it (positions and length), and its words must be equal.
    """
    hits = scanned.where("pos is not null").select("rid", "pos", "h", "size", "first", "near")
    seen = hits.groupBy("h").agg(F.count("*").alias("n"))
    counted = tokens.join(seen, "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = counted.groupBy("item", "win", "size").agg(F.min(F.struct("n", "h", "p")).alias("least"))
    prefix = staged(
        rarest.where("least.n > 0").select("item", "win", F.col("size").alias("w"), "least.h", "least.p"),
        "prefix",
    )
    at = F.col("pos") - F.col("p")
    inside = at - F.col("first")
    near = F.split("near", " ")
    joined = hits.drop("size").join(prefix, "h").where(at >= F.col("first"))
    joined = joined.where(inside + F.col("w") <= F.size(near))
    same = F.array_join(F.slice(near, inside + 1, F.col("w")), " ") == F.col("win")
    return joined.where(same).select("rid", at.alias("start"), F.col("w").alias("size"), "item").distinct()


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shingle: int = 5,
    keep: list[str] | None = None,
) -> DataFrame:
    """(row, rid, n_words, n_hit, items): for every document the words inside any
    occurrence of an item's window, and the items found, as a sorted array.

    Null texts have no words. An item of fewer than ``window`` words is one window.
    Items with one text all count; null item ids count for hits and are not listed.
    Without items, or without documents, nothing is hit. Repeated documents are
    judged each by itself.
    """
    tokens = item_shingles(items, window, shingle, item_id, item_text)
    scanned = scan(docs, tokens, doc_text, keep or docs.columns, window, shingle)
    found = staged(occurrences(scanned, tokens), "occurrences")
    before = Window.partitionBy("rid").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    runs = found.groupBy("rid", "start").agg(F.max("size").alias("size"))
    runs = runs.withColumn("past", F.coalesce(F.max(F.col("start") + F.col("size")).over(before), F.lit(0)))
    new = F.greatest(F.lit(0), F.col("start") + F.col("size") - F.greatest("start", "past"))
    hit = runs.groupBy("rid").agg(F.sum(new).alias("n_hit"))
    listed = found.groupBy("rid").agg(F.array_sort(F.collect_set("item")).alias("items"))
    per_doc = scanned.where("pos is null").select("row", "rid", F.col("n_words").cast("long").alias("n_words"))
    return (
        per_doc.join(staged(hit.join(listed, "rid"), "hit"), "rid", "left")
        .withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    )
