"""Whitening against a dense decomposition of the centred rows."""

from __future__ import annotations

import numpy as np
import pytest

from tickmacro.llm import whitening
from tickmacro.llm.queries import LLM_QUERIES

NAN = float("nan")


def table(spark, vectors, extra=()):
    rows = [(k, None if v is None else [None if x is None else float(x) for x in v], "?", "?") for k, v in enumerate([*vectors, *extra])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, row string, n string").repartition(5)


def check(rows, vectors, most=32, rank=None):
    """Compare rows, one for each vector and component, with numpy."""
    x = np.floor(64 * np.asarray(vectors, float)) + 1_000_000
    n = len(x)
    ints = x.astype(np.int64).astype(object)
    deviation = ((n * ints - ints.sum(axis=0)) ** 2).sum(axis=1)
    centred = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    rank = rank or int((s > 1e-9 * s[0]).sum())
    count = min(most, rank)
    got = {(r["id"], r["component"]): r for r in rows}
    assert len(rows) == len(got) == n * count
    want = centred @ vt[:count].T / s[:count] * np.sqrt(n)
    for c in range(count):
        column = np.array([got[i, c + 1]["whitened"] for i in range(n)])
        sign = np.sign(column @ want[:, c])
        assert np.abs(column - sign * want[:, c]).max() < 1e-6
        assert got[0, c + 1]["explained"] == pytest.approx(s[c] ** 2 / (s**2).sum(), rel=1e-9)
    assert all(r["n"] == n and r["deviation"] == min(deviation[i], 2**63 - 1) for (i, _), r in got.items())
    assert {r["identity_error"] for r in rows} < {rows[0]["identity_error"]} | {-1.0} and rows[0]["identity_error"] < 1e-7


def run(df):
    out = whitening.whiten(df).selectExpr("row.vec_id as id", "component", "n", "deviation", "whitened", "explained", "identity_error")
    return [r.asDict() for r in out.collect()]


def test_scales_and_dependent_dimensions_equal_numpy(spark):
    rng = np.random.default_rng(3)
    even = rng.normal(size=(400, 40)) * np.linspace(1, 3, 40) + 1000
    check(run(table(spark, even)), even)
    steep = rng.normal(size=(300, 5)) * [1e8, 1e5, 1e3, 1, 0.1]
    check(run(table(spark, steep)), steep, rank=5)
    base = rng.integers(-900, 900, (300, 4)).astype(float)
    dependent = np.column_stack([base, base[:, 0] + base[:, 1], base[:, 2], np.full(300, 7.0)])
    check(run(table(spark, dependent)), dependent, rank=4)


def test_two_passes_do_where_the_condition_is_good(spark):
    rng = np.random.default_rng(4)
    assert whitening.fit(table(spark, rng.normal(size=(500, 8))).selectExpr("embedding as v")).passes == 2


def test_unusable_vectors_are_left_out(spark):
    rng = np.random.default_rng(5)
    good = rng.normal(size=(60, 3))
    odd = [None, [], [1, None, 2], [1, NAN, 2], [1, float("inf"), 2], [1, 2], [1, 2, 3, 4]]
    check(run(table(spark, good, odd)), good)
    copies = np.repeat(good[:5], 7, axis=0)
    check(run(table(spark, copies)), copies)


def test_entries_beyond_a_long_do_not_crash(spark):
    rows = run(table(spark, [[1e300, 1], [-1e300, 2], [0, 3], [5, 9]]))
    assert rows and all(r["n"] == 4 and 0 <= r["deviation"] <= 2**63 - 1 for r in rows)


def test_nothing_to_whiten(spark):
    for vectors in ([], [None], [[]], [[1, 2]], [[1, 2]] * 3):
        assert run(table(spark, vectors)) == []


def test_query_equals_numpy(spark, sf_dir):
    rows = [r.asDict() for r in LLM_QUERIES["op11_whitening"](spark, sf_dir).withColumnRenamed("vec_id", "key").collect()]
    pairs = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    place = {r.vec_id: k for k, r in enumerate(pairs)}
    check([{**r, "id": place[r["key"]]} for r in rows], [r.embedding for r in pairs])


def test_triangular_solve():
    rng = np.random.default_rng(6)
    r = np.triu(rng.normal(size=(70, 70))) + 9 * np.eye(70)
    rows = rng.normal(size=(10, 70))
    assert np.allclose(whitening.solve_upper(rows, r) @ r, rows)
