"""Fill-in-the-middle against a regular expression, cut by cut and whole."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import LONG
from tickmacro.llm import fill_middle as fim

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


@settings(max_examples=300, deadline=None)
@given(st.text("aZ é𝒳 \n<P>[`{@", max_size=80), st.sampled_from([1, 2, 3, 16, 4096]))
def test_every_cut_is_where_the_units_end(text, block):
    units = UNIT.findall(text)
    tree = fim.BlockTree(fim.unit_starts(fim.code_points(text.encode())), block)
    assert tree.n == len(units)
    assert [tree.cut(k) for k in range(len(units) + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]


def test_a_run_of_letters_over_many_blocks_is_one_unit():
    tree = fim.BlockTree(fim.unit_starts(fim.code_points(b"." + b"x" * 100_000 + b".")))
    assert (tree.n, [tree.cut(k) for k in range(4)]) == (3, [0, 1, 100_001, 100_002])


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_odd_rows_equal_brute_force_and_come_back(make_docs, odd):
    marks = [(100 + k, t) for k, t in enumerate(["a <P> b", "<", "<S", "S>", "<M", "P><S", "é𝒳\r\n", LONG * 3] * 12)]
    for docs in (odd, make_docs(marks)):
        made = fim.fill_middle(docs, block=64)
        rows = made.withColumn("again", fim.restored(F.col("output"), F.col("form"))).collect()
        assert {r.form for r in rows} == {"plain", "psm", "spm"} or docs is odd
        for r in rows:
            assert tuple(r)[1:6] == brute(r.row.doc_id, r.row.text)
            assert r.again == (r.row.text or "")
        assert sorted(rows[0].row.asDict()) == sorted(docs.columns)


def test_bytes_that_are_no_text_come_back(spark):
    docs = spark.sql("SELECT id AS doc_id, cast(X'41FF42C3' AS string) AS text FROM range(20)")
    made = fim.fill_middle(docs).select("form", fim.restored(F.col("output"), F.col("form")).cast("binary").alias("b"))
    assert {bytes(r.b) for r in made.collect()} == {b"A\xffB\xc3"}
    assert np.array_equal(fim.code_points(b"A\xff"), [0x41, 0xDCFF])


def test_no_documents(empty):
    assert fim.fill_middle(empty).count() == 0
