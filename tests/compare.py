"""Run a query and its SQL form on the same tables and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _kind(name: str) -> str:
    """Spark's type name in SQL terms."""
    name = name.lower()
    return {"string": "varchar", "int": "integer", "timestamp_ntz": "timestamp"}.get(name, name)


def _sortable(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def compare(actual: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Assert equal names, types and rows; returns the row count."""
    expected = db.sql(sql)
    names = sorted(actual.columns)
    assert names == sorted(expected.columns)
    types = {f.name: _kind(f.dataType.simpleString()) for f in actual.schema.fields}
    sql_types = dict(zip(expected.columns, (_kind(str(t)) for t in expected.types)))
    assert types == sql_types
    quoted = [f'"{n}"' for n in names]
    want = sorted(expected.project(", ".join(quoted)).fetchall(), key=_sortable)
    got = sorted((tuple(r) for r in actual.select(*names).collect()), key=_sortable)
    assert len(got) == len(want), f"{len(got)} rows, expected {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if not _same(g, w)]
    assert not wrong, f"{len(wrong)} rows differ, first {wrong[0]}"
    return len(got)


def _same(got: tuple, want: tuple) -> bool:
    for g, w in zip(got, want):
        if isinstance(g, float) and isinstance(w, float) and math.isnan(g) and math.isnan(w):
            continue
        if g != w:
            return False
    return True
