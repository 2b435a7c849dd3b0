"""Whitening by shifted Cholesky QR: Gram passes, triangular solves, one small SVD."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmacro.llm.common import packed, staged

#: Entries are counted in steps of 1/SCALE from OFFSET on.
SCALE, OFFSET = 64, 1_000_000
#: Rows are orthonormal enough once the eigenvalues of their Gram matrix are this close to
#: one; the last factor, its square root, takes up what is left.
CLOSE = 1e-8
#: Factors at most; two do where the condition is good.
PASSES = 8
#: Components whose deviation is below this share of the largest are rounding errors.
RANK = 1e-11
_UNIT = np.finfo(float).eps / 2
_EDGE = float(1 << 62)
_LARGEST = (1 << 63) - 1


@dataclass
class Fit:
    """What the fit list gave: ``base + rest / n`` is the mean of each dimension."""

    n: int
    base: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    passes: int


def steps(values: np.ndarray) -> np.ndarray:
    """Entries as whole steps; what no long could hold stays at the edge of the range."""
    return np.clip(np.floor(SCALE * values), -_EDGE, _EDGE).astype(np.int64) + OFFSET


def vectors(column: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The places of the usable vectors in an Arrow list column, and one flat array of
    their lengths; with ``dims`` the places of that length and their entries as rows."""
    sizes = np.asarray(column.value_lengths().fill_null(-1))
    flat = column.flatten()
    entries = flat.to_numpy(zero_copy_only=False).astype(float)
    bad = np.append(0, np.cumsum(~np.isfinite(entries)))
    ends = np.cumsum(np.maximum(sizes, 0))
    starts = ends - np.maximum(sizes, 0)
    good = (sizes > 0) & (bad[ends] == bad[starts])
    if dims is None:
        places = np.flatnonzero(good)
        return places, sizes[places]
    places = np.flatnonzero(good & (sizes == dims))
    return places, entries[starts[places][:, None] + np.arange(dims)]


def solve_upper(rows: np.ndarray, r: np.ndarray, block: int = 32) -> np.ndarray:
    """``rows`` times the inverse of an upper triangle, by blocks of columns."""
    out = np.array(rows, float)
    for lo in range(0, r.shape[0], block):
        hi = min(lo + block, r.shape[0])
        out[:, lo:hi] -= out[:, :lo] @ r[:lo, lo:hi]
        for j in range(lo, hi):
            out[:, j] = (out[:, j] - out[:, lo:j] @ r[lo:j, j]) / r[j, j]
    return out


def _centred(entries: np.ndarray, base: np.ndarray, rest: np.ndarray, n: int) -> np.ndarray:
    return (steps(entries) - base).astype(float) - rest / n


def _summed(rows: DataFrame, work: Callable[[list[pa.Array]], np.ndarray | None]) -> dict[int, float]:
    """Sums by place of the arrays that ``work`` makes of the batches: added up in each
    task, then by place over all of them. One row for each place reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            part = work(batch.column(0))
            if part is not None:
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["i", "v"])

    parts = rows.select("v").mapInArrow(run, "i long, v double")
    return {r["i"]: r["v"] for r in parts.groupBy("i").agg(F.sum("v").alias("v")).toLocalIterator()}


def _totals(rows: DataFrame) -> tuple[int, int, np.ndarray]:
    """(dims, n, sums): the most frequent length of usable vectors, the greater on a tie,
    how many vectors have it, and the exact sums of their steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for dims in np.unique(vectors(batch.column(0))[1]).tolist():
                places, entries = vectors(batch.column(0), dims)
                x = steps(entries)
                wide = float(np.abs(x).max(initial=0)) * len(x) >= _EDGE
                sums = x.astype(object).sum(axis=0).tolist() if wide else x.sum(axis=0).tolist()
                n, old = found.get(dims, (0, [0] * dims))
                found[dims] = [n + len(places), [a + b for a, b in zip(old, sums)]]
        for dims, (n, sums) in found.items():
            cells = [str(v) for v in [n, *sums]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([dims] * (dims + 1), pa.int64()), pa.array(range(dims + 1), pa.int64()), pa.array(cells)],
                ["dims", "i", "v"],
            )

    parts = rows.select("v").mapInArrow(run, "dims long, i long, v string")
    sums = staged(parts.groupBy("dims", "i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")), "totals")
    most = sums.where("i = 0").orderBy(F.desc("v"), F.desc("dims")).first()
    if most is None:
        return 0, 0, np.zeros(0, object)
    dims, out = most["dims"], np.zeros(most["dims"], object)
    for r in sums.where((F.col("dims") == dims) & (F.col("i") > 0)).toLocalIterator():
        out[r["i"] - 1] = int(r["v"])
    return dims, int(most["v"]), out


def _gram(rows: DataFrame, dims: int, make: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The Gram matrix of what ``make`` makes of the usable entries."""

    def work(column: pa.Array) -> np.ndarray | None:
        places, entries = vectors(column, dims)
        if not len(places):
            return None
        made = make(entries)
        return (made.T @ made)[np.triu_indices(width)]

    cells, out = _summed(rows, work), np.zeros((width, width))
    out[np.triu_indices(width)] = [cells[i] for i in range(width * (width + 1) // 2)]
    return np.triu(out) + np.triu(out, 1).T


def fit(rows: DataFrame, most: int = 32) -> Fit | None:
    """Fit on the vectors ``v`` (array of double) of ``rows``; None without one.

    Every pass solves the centred rows through all factors found so far and takes the
    Gram matrix of the result, whose Cholesky factor is the next one. The first factor,
    and any whose matrix is not safely positive, has its diagonal raised by a bound on the
    rounding errors, so that it always exists. The product of the factors has the
    singular values and right vectors of the centred rows themselves: no eigenvalue is
    read off a covariance, which would lose half of the digits.
    """
    dims, n, sums = _totals(rows)
    if not n:
        return None
    base = np.array([int(s) // n for s in sums], np.int64)
    rest = np.array([float(int(s) % n) for s in sums])
    factors: list[np.ndarray] = []

    def solved(entries: np.ndarray) -> np.ndarray:
        q = _centred(entries, base, rest, n)
        for r in factors:
            q = solve_upper(q, r)
        return q

    product = np.eye(dims)
    while True:
        gram = _gram(rows, dims, solved, dims)
        if not factors and not np.trace(gram) > 0:
            return Fit(n, base, rest, np.zeros((dims, 0)), np.zeros(0), 0.0, 1)
        left, vecs = np.linalg.eigh(gram)
        last = (vecs * np.sqrt(np.maximum(left, 0))) @ vecs.T @ product
        _, sigma, vt = np.linalg.svd(last)
        count = int((sigma > RANK * sigma[0]).sum())
        # What is still far from one must be directions in which the rows do not differ.
        far = int((np.abs(left - 1) > CLOSE).sum())
        if len(factors) == PASSES or (factors and far <= dims - count):
            break
        shift = 11 * (n * dims + dims * (dims + 1)) * _UNIT * np.trace(gram)
        try:
            if not factors or left[0] <= shift:
                raise np.linalg.LinAlgError
            factor = np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            factor = np.linalg.cholesky(gram + shift * np.eye(dims)).T
        factors.append(factor)
        product = factor @ product
    count = min(most, count)
    spread = sigma**2 / n
    return Fit(n, base, rest, vt[:count].T, spread[:count], float(spread.sum()), len(factors) + 1)


def identity_error(rows: DataFrame, found: Fit) -> float:
    """The largest entry of the covariance of the whitened rows minus the identity."""
    width = len(found.eigenvalues)
    matrix = found.components / np.sqrt(found.eigenvalues)

    def with_one(entries: np.ndarray) -> np.ndarray:
        white = _centred(entries, found.base, found.rest, found.n) @ matrix
        return np.column_stack([white, np.ones(len(white))])

    gram = _gram(rows, len(found.base), with_one, width + 1) / found.n
    covariance = gram[:width, :width] - np.outer(gram[:width, width], gram[:width, width])
    return float(np.abs(covariance - np.eye(width)).max(initial=0.0))


def _deviation(x: np.ndarray, found: Fit) -> np.ndarray:
    """The sums of (n * x - S)^2, exact; what no long could hold is the largest long."""
    away = x - found.base
    if (float(np.abs(away).max(initial=0)) + 1) * found.n < (2.0**62 / x.shape[1]) ** 0.5:
        scaled = away * found.n - found.rest.astype(np.int64)
        return (scaled * scaled).sum(axis=1)
    scaled = away.astype(object) * found.n - np.array([int(r) for r in found.rest], object)
    return np.array([min(v, _LARGEST) for v in (scaled * scaled).sum(axis=1)], np.int64)


def whiten(table: DataFrame, vector: str = "embedding", keep: list[str] | None = None, most: int = 32) -> DataFrame:
    """(row, component, n, deviation, whitened, explained, identity_error), a row for each
    usable row of ``table`` and component.

    Rows whose vector is null or empty, or holds a null or non-finite entry, are left out,
    and so are those of another length than the most frequent one. All others are the fit
    list, copies as often as they come. There are as many components as the rows have
    dimensions in which they differ, ``most`` at most; a table without two different
    vectors gives no rows. Matrices of dims x dims are all that the driver holds, whatever
    the number of rows; each pass reads the table again and keeps nothing.
    """
    body = table[f"`{vector}`"].cast("array<double>")
    rows = packed(table, keep or table.columns, v=body)
    row_type = rows.schema["row"].dataType.simpleString()
    kind = f"row {row_type}, deviation long, whitened array<double>"
    found = fit(rows, most)
    if found is None or not len(found.eigenvalues):
        out = rows.where(F.lit(False)).select("row", F.lit(0).cast("long").alias("deviation"), F.col("v").alias("whitened"))
        error, n, explained = 0.0, 0, [0.0]
    else:
        error, n = identity_error(rows, found), found.n
        explained = (found.eigenvalues / found.trace).tolist()
        matrix = found.components / np.sqrt(found.eigenvalues)
        dims, width = matrix.shape

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                places, entries = vectors(batch.column(1), dims)
                white = _centred(entries, found.base, found.rest, found.n) @ matrix
                ends = pa.array(np.arange(0, white.size + 1, width), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(places)),
                        pa.array(_deviation(steps(entries), found)),
                        pa.ListArray.from_arrays(ends, pa.array(white.ravel())),
                    ],
                    ["row", "deviation", "whitened"],
                )

        out = rows.mapInArrow(run, kind)
    each = out.select("row", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "row",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*[F.lit(x) for x in explained]), F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
