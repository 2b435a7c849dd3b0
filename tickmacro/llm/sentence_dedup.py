"""Substring dedup by sliding spans of consecutive sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tickmacro.llm.common import packed, staged

#: Full stops of Latin, Chinese, Japanese, Indic, Arabic, Armenian and Ethiopic texts, and line breaks.
_STOPS = r".!?\n\u3002\uFF01\uFF1F\uFF61\uFF0E\u2026\u061F\u06D4\u0964\u0965\u0589\u1362"

#: Scripts written without spaces: Thai to Myanmar, Khmer, Tai, Balinese, kana, Han, Yi, Javanese.
_UNSPACED = (
    r"\u0E00-\u109F\u1780-\u17FF\u1950-\u19DF\u1A20-\u1AAF\u1B00-\u1B7F\u3005-\u3007\u3040-\u30FF"
    r"\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uA000-\uA4CF\uA980-\uA9DF\uF900-\uFAFF\uFF66-\uFF9F"
    r"\U00020000-\U0003FFFF"
)

_SENTENCE = re.compile(rf"([^{_STOPS}]*)[{_STOPS}]*\s*")
_WORD = re.compile(rf"[{_UNSPACED}]|[^\s{_STOPS}{_UNSPACED}]+")
_NO_SPACES = re.compile(f"[{_UNSPACED}]")

#: Sentences of up to so many words are never cut, longer ones into parts of one word less
#: at most. A passage of 51 words has runs of 25 words in whole parts wherever it begins.
LONGEST = 14

#: Mixes the hashes of words, modulo 2^64.
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _cuts(words: list[str], sizes: list[int], window: int, shingle: int) -> list[list[int]]:
    """For long sentences of ``sizes`` words each the words before which they are cut, by
    their numbers: those whose hash, with that of the next, is the least of ``window`` in
    a row within the sentence.

    That depends on the words around them alone, and they are at most
    ``window + shingle - 1`` words apart, so a passage is cut alike wherever it begins.
    """
    each = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    hashes = np.zeros(len(each) - shingle + 1, np.uint64)
    for k in range(shingle):
        hashes = (hashes + each[k : k + len(hashes)]) * _FACTOR
    of = np.repeat(np.arange(len(sizes)), sizes)
    inside = of[: len(hashes) - window + 1] == of[window + shingle - 2 :]
    least = np.lib.stride_tricks.sliding_window_view(hashes, window)[inside].argmin(axis=1)
    chosen = np.unique(np.flatnonzero(inside) + least)
    firsts = np.cumsum([0, *sizes[:-1]])
    out: list[list[int]] = [[] for _ in sizes]
    for k, n in zip(of[chosen].tolist(), (chosen - firsts[of[chosen]]).tolist()):
        if n:
            out[k].append(n)
    return out


def sentences(
    text: str, longest: int = LONGEST, window: int = 12, shingle: int = 2
) -> list[tuple[int, int, int, str]]:
    """(start, end, words, normal form) of the sentences of a text, which they cover whole.

    A sentence ends with a run of full stops or line breaks and the spaces after it.
    Only one of more than ``longest`` words is cut, see ``_cuts``. Full stops without a
    word belong to the sentence before them, at the start to the first. Every character
    of a script without spaces is a word. The normal form has single spaces and no upper
    case.
    """
    spaced = _NO_SPACES.search(text) is None
    whole: list[list] = []
    long: list[tuple[int, int, list]] = []
    for m in _SENTENCE.finditer(text):
        start, stop = m.span()
        if start == stop:
            continue
        body = m[1]
        n = len(body.split()) if spaced else len(_WORD.findall(body))
        if not n:
            if whole:
                whole[-1][1] = stop
            else:
                whole.append([start, stop, 0, ""])
            continue
        own = start
        if whole and not whole[-1][2]:
            start = whole.pop()[0]
        if n > longest:
            long.append((len(whole), own, [(w.start() + own, w[0]) for w in _WORD.finditer(body)]))
            whole.append([start, stop, n, None])
        else:
            whole.append([start, stop, n, " ".join(m[0].lower().split())])
    if not long:
        return [tuple(part) for part in whole]
    words = [w.lower() for *_, found in long for _, w in found]
    cuts = _cuts(words, [len(found) for *_, found in long], window, shingle)
    out, after = [], 0
    for (place, own, found), numbers in zip(long, cuts):
        out += whole[after:place]
        start, stop, n, _ = whole[place]
        at = [start, *(found[k][0] for k in numbers), stop]
        edges = [0, *numbers, n]
        for k, (lo, hi) in enumerate(zip(at, at[1:])):
            out.append((lo, hi, edges[k + 1] - edges[k], " ".join(text[max(lo, own) : hi].lower().split())))
        after = place + 1
    out += whole[after:]
    return [tuple(part) for part in out]


def spans(
    parts: list[tuple[int, int, int, str]], least: int = 2, words: int = 25
) -> list[tuple[int, int, bytes]]:
    """(start, end, hash) of the run that begins at each sentence: the shortest one of
    ``least`` sentences or more with ``words`` words or more, where there is one.

    The run depends on what follows its start alone, so a passage gives the same runs
    wherever it stands. What is left at the end of a text gives one more, the last run
    and all after it, so that copies go whole. Each sentence is hashed once, a run as the hashes of its
    sentences; both have 128 bits.
    """
    hashes = [xxh3_128_digest(p[3].encode("utf-8", "surrogatepass")) for p in parts]
    out, past, total = [], 0, 0
    for first in range(len(parts)):
        while past < len(parts) and (total < words or past - first < least):
            total += parts[past][2]
            past += 1
        if total < words or past - first < least:
            if out and out[-1][1] < parts[-1][1]:
                out.append((out[-1][0], parts[-1][1], xxh3_128_digest(b"".join(hashes[first - 1 :]))))
            break
        out.append((parts[first][0], parts[past - 1][1], xxh3_128_digest(b"".join(hashes[first:past]))))
        total -= parts[first][2]
    return out


#: What a document is known by: two hashes of its id and text, 128 bits in all.
_KEY = ["k1", "k2"]


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """``docs`` as (row, k1, k2, id, text).

    The key hashes the id and the text: a row repeated whole has the key of the first
    and counts as the same document.
    """
    body, given = docs[f"`{text}`"].cast("string"), docs[f"`{doc_id}`"]
    k1, k2 = F.xxhash64(given, body), F.xxhash64(body, F.lit("2"), given)
    return packed(docs, keep or docs.columns, k1=k1, k2=k2, id=given, text=body)


def runs(rows: DataFrame, least: int = 2, words: int = 25) -> DataFrame:
    """(k1, k2, id, n, runs), staged: for each text the number of its sentences, and its
    spans as structs of start, end and the two halves of their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sizes, starts, ends, hashes = [], [0], [], [], []
            for value in batch.column(3):
                parts = sentences(value.as_py() or "")
                counts.append(len(parts))
                for start, end, digest in spans(parts, least, words):
                    starts.append(start)
                    ends.append(end)
                    hashes.append(digest)
                sizes.append(len(starts))
            halves = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            flat = pa.StructArray.from_arrays(
                [
                    pa.array(starts, pa.int32()),
                    pa.array(ends, pa.int32()),
                    pa.array(np.ascontiguousarray(halves[:, 0])),
                    pa.array(np.ascontiguousarray(halves[:, 1])),
                ],
                ["start", "end", "h1", "h2"],
            )
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(3)), pa.array(counts, pa.int64()), lists],
                [*_KEY, "id", "n", "runs"],
            )

    given = rows.select(*_KEY, "id", "text")
    id_type = given.schema["id"].dataType.simpleString()
    kind = "array<struct<start: int, end: int, h1: long, h2: long>>"
    return staged(given.mapInArrow(run, f"k1 long, k2 long, id {id_type}, n long, runs {kind}"), "runs")


def repeated(found: DataFrame) -> DataFrame:
    """(k1, k2, spans): the stretches of each document that a non-first repeated span covers,
    as structs of start and end; they may overlap.

    The first span of a hash is that of the smallest id, then key and place; null ids
    come last. Hashes alone are counted first, aggregated before the shuffle, so a
    passage in a third of all documents is a row for each task; only the spans of
    hashes met twice go on. The join has one row for each hash on one side.
    """
    each = found.select(*_KEY, "id", F.explode("runs").alias("r")).select(*_KEY, "id", "r.*")
    twice = each.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    again = staged(each.join(staged(twice, "twice"), ["h1", "h2"]), "again")
    order = F.struct(F.col("id").isNull(), "id", *_KEY, "start")
    firsts = again.groupBy("h1", "h2").agg(F.min(order).alias("at"))
    later = again.join(firsts, ["h1", "h2"]).where(order != F.col("at")).select(*_KEY, "start", "end")
    # A document has fewer spans than sentences, so what meets here is bounded by its text;
    # a row repeated whole brings each of them again.
    return later.distinct().groupBy(*_KEY).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def _merged(spans_: list[dict]) -> list[dict[str, int]]:
    """Sorted stretches with those that overlap or touch joined."""
    out: list[dict[str, int]] = []
    for s in spans_:
        if out and s["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append({"start": s["start"], "end": s["end"]})
    return out


def dedup(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    keep: list[str] | None = None,
    least: int = 2,
    words: int = 25,
) -> DataFrame:
    """(row, text, n_sentences, removed): every document without its repeated sentences.

    ``removed`` has their (start, end) in code points, end exclusive, touching ones
    joined. A null text stays null, an empty or short one stays as it is; a document
    copied under another id loses all that spans cover. Repeats inside one text count
    too, the first stays.
    """
    rows = keyed(docs, text, doc_id, keep)
    found = runs(rows, least, words)
    counts = found.groupBy(*_KEY).agg(F.max("n").alias("n"))
    gone = staged(counts.join(repeated(found), _KEY, "left"), "repeated")
    joined = rows.join(gone, _KEY, "left").select("row", "text", "spans", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = [], []
            for body, spans_ in zip(batch.column(1), batch.column(2)):
                cuts = _merged(spans_.as_py() or [])
                removed.append(cuts)
                if cuts:
                    whole = body.as_py()
                    at = [0, *(x for c in cuts for x in (c["start"], c["end"])), len(whole)]
                    texts.append("".join(whole[lo:hi] for lo, hi in zip(at[::2], at[1::2])))
                else:
                    texts.append(body.as_py())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(texts, pa.string()),
                    batch.column(3),
                    pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                ["row", "text", "n_sentences", "removed"],
            )

    row_type = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(
        run, f"row {row_type}, text string, n_sentences long, removed array<struct<start: long, end: long>>"
    )
