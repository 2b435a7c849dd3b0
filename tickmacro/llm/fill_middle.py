"""Fill-in-the-middle: texts cut at unit bounds that a tree of block counts finds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmacro.llm.common import packed

#: What stands before each part.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts, how many are cut, and how many of those have the suffix first.
CUT_SHARE, SUFFIX_FIRST_SHARE = 90, 20
#: Code points of a block.
BLOCK = 4096


def code_points(text: bytes) -> np.ndarray:
    """The code points of a UTF-8 text; bytes that are none count as one each."""
    return np.frombuffer(text.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), "<u4")


def to_bytes(points: np.ndarray) -> bytes:
    return points.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogateescape")


def unit_starts(points: np.ndarray) -> np.ndarray:
    """True where a unit begins: a run of letters A-Z, a-z, or any other code point."""
    folded = points | np.uint32(0x20)
    letter = (folded >= 0x61) & (folded <= 0x7A)
    starts = np.ones(len(points), bool)
    starts[1:] = ~(letter[1:] & letter[:-1])
    return starts


class BlockTree:
    """A Fenwick tree over the blocks of a text, with the units that begin in each and
    the code points of each."""

    def __init__(self, starts: np.ndarray, block: int = BLOCK):
        self.starts, self.block = starts, block
        firsts = np.arange(0, len(starts), block)
        units = np.add.reduceat(starts, firsts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)
        points = np.diff(np.append(firsts, len(starts)))
        self.units, self.points = self._tree(units), self._tree(points)
        self.n = int(units.sum())

    @staticmethod
    def _tree(counts: np.ndarray) -> list[int]:
        tree = [0, *counts.tolist()]
        for i in range(1, len(tree)):
            above = i + (i & -i)
            if above < len(tree):
                tree[above] += tree[i]
        return tree

    def cut(self, units: int) -> int:
        """The code points of the first ``units`` units.

        Halving steps go down to the last block before which no more than ``units``
        units begin; the start of the next one is looked up in that block alone.
        """
        if units >= self.n:
            return len(self.starts)
        at, before, left = 0, 0, units
        step = 1 << (len(self.units) - 1).bit_length()
        while step:
            nxt = at + step
            if nxt < len(self.units) and self.units[nxt] <= left:
                at, left, before = nxt, left - self.units[nxt], before + self.points[nxt]
            step >>= 1
        inside = np.flatnonzero(self.starts[before : before + self.block])
        return before + int(inside[left])


def arranged(text: bytes, h: list[int], block: int = BLOCK) -> tuple[int, str, int | None, int | None, bytes]:
    """(n, form, prefix_chars, middle_chars, output) of a text under four numbers."""
    points = code_points(text)
    tree = BlockTree(unit_starts(points), block)
    marks = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
    if not text or any(m in text for m in marks) or h[2] % 100 >= CUT_SHARE:
        return tree.n, "plain", None, None, text
    first, second = sorted(tree.cut(x % (tree.n + 1)) for x in h[:2])
    prefix, middle, suffix = (to_bytes(p) for p in (points[:first], points[first:second], points[second:]))
    p, s, m = marks
    if h[3] % 100 < SUFFIX_FIRST_SHARE:
        return tree.n, "spm", first, second - first, s + suffix + p + prefix + m + middle
    return tree.n, "psm", first, second - first, p + prefix + s + suffix + m + middle


def numbers(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four numbers of 32 bits for an id; null counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_middle(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    seed: int = 1,
    keep: list[str] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """``docs`` as (row, n, form, prefix_chars, middle_chars, output).

    ``n`` counts the units of a text, ``form`` is plain, psm or spm, ``output`` the text
    with its parts in that order. The id alone decides on the cuts, so reruns agree and
    rows of one id and text come out alike. Null texts count as empty and stay plain, as
    do texts that hold a mark. A text of any length costs a few times its size, one text
    at a time; nothing is shuffled. No rows give none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            hashes = zip(*(batch.column(k).to_pylist() for k in range(2, 6)))
            made = [arranged(t.as_py() or b"", list(h), block) for t, h in zip(texts, hashes)]
            columns = list(zip(*made)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays], ["row", "n", "form", "prefix_chars", "middle_chars", "output"]
            )

    hashes = {f"h{k + 1}": h for k, h in enumerate(numbers(docs[f"`{doc_id}`"], seed))}
    rows = packed(docs, keep or docs.columns, text=docs[f"`{text}`"].cast("string"), **hashes)
    row_type = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(
        run, f"row {row_type}, n long, form string, prefix_chars long, middle_chars long, output binary"
    )
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text again, from the output and its form alone.

    No part holds a mark, and none arises where parts meet: a mark has its ``<`` and
    ``>`` at its ends only. Parts are cut by bytes, so bytes that are no text come back too.
    """

    def after(whole: Column, head: Column, mark: str) -> Column:
        past = F.octet_length(head) + len(mark) + 1
        return F.substring(whole.cast("binary"), past, F.octet_length(whole)).cast("string")

    def split(first: str, second: str, swap: bool) -> Column:
        body = after(output, F.lit(""), first)
        one = F.substring_index(body, second, 1)
        rest = after(body, one, second)
        two = F.substring_index(rest, MIDDLE, 1)
        middle = after(rest, two, MIDDLE)
        return F.concat(two, middle, one) if swap else F.concat(one, middle, two)

    return (
        F.when(form == "psm", split(PREFIX, SUFFIX, False))
        .when(form == "spm", split(SUFFIX, PREFIX, True))
        .otherwise(output)
    )
