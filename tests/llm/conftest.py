from __future__ import annotations

import pytest
from pyspark.sql import types as T

LONG = " ".join(f"w{k % 4999}x{k}" for k in range(60_000))
PLAIN = "The quick brown fox jumps over the lazy dog near the old river bank today."

#: Rows with nulls, empty and long texts, copies, and repeated rows.
ROWS = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \t\n ", None, None),
    (4, PLAIN, "en", "b"),
    (5, PLAIN, "de", "b"),
    (5, PLAIN, "de", "b"),
    (None, PLAIN + " And more of it follows here.", None, "b"),
    (6, LONG, "en", "b"),
    (7, "x", "en", None),
    (8, "one two three four five one two three four five one two three four five", "en", "a"),
]

_NAMES = [
    "row", "rid", "size", "key", "n_words", "stratum", "kept", "fp", "spans", "base", "held", "shard",
    "label", "id", "host", "Words", "value", "start", "items", "score",
]


@pytest.fixture(scope="session")
def make_docs(spark):
    """A table of documents with columns that clash with what operators use inside."""

    def make(rows, clash=True):
        names = _NAMES if clash else []
        schema = T.StructType(
            [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
            + [T.StructField(c, T.StringType()) for c in ("lang", "source", *names)]
        )
        full = [tuple(r) + (None,) * (4 - len(r)) + ("?",) * len(names) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def odd(make_docs):
    return make_docs(ROWS)


@pytest.fixture(scope="session")
def empty(make_docs):
    return make_docs([])
