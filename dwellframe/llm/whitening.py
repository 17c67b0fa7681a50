r"""Embedding whitening: components by QDWH spectral divide and conquer, applied to every row.

Entries c become integers floor(64 c) + 1000000. Two passes of Spark gather exact integer sums over all vectors: the number
and per-dimension sums first, then products of entries centred at the integer next to the mean, from which the covariance
follows without cancellation. A third pass measures the covariance of the whitened rows. Tasks send a sum for each pair of
dimensions, added up in Spark; only the dimension's square reaches the driver.

:func:`spectral` finds the eigenvectors: the polar factor of the covariance shifted by its mean eigenvalue, by QR-based
dynamically weighted Halley iterations, gives the projector onto the eigenvalues above the shift. Bases of its range and
of the rest split the problem in two, and so on until the parts are single components. Rows are whitened by a matrix
product in each task, with the components in the task's closure.

A row counts if its vector is not null, not empty, of the most frequent length (of equally frequent ones the longest) and holds only finite
entries below ``LARGEST`` in size (whose integers and sums stay exact). Other rows give none. Components without variance (e at most 1e-12 of the largest)
give none, since whitening is not defined there; so an empty table, one row or equal rows give no rows. Null and repeated ids
are rows like others. Columns other than the two are not read. ``deviation`` is null where it exceeds a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellframe.llm.common import bound_batches

SCALE, OFFSET = 64, 1_000_000
LARGEST = float(1 << 40)
EXACT = 1 << 53  # integers up to here are exact as doubles
SUM = pa.decimal128(38, 0)
EPS = float(np.finfo(float).eps)


# --- spectral divide and conquer ----------------------------------------------------------------


def polar(a: np.ndarray) -> np.ndarray | None:
    """The orthogonal polar factor of a symmetric matrix by QDWH; None if the matrix is singular to working precision."""
    size = len(a)
    x = a / np.linalg.norm(a)
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        return None
    if low < 10 * EPS:
        return None
    eye = np.eye(size)
    for _ in range(30):
        d = (4 * (1 - low**2) / low**4) ** (1 / 3) if low < 1 else 0.0
        h = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + d)))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
        y = b / c * x + (h - b / c) / np.sqrt(c) * q[:size] @ q[size:].T
        y = (y + y.T) / 2
        moved, x = np.linalg.norm(y - x), y
        low = min(1.0, low * (h + b * low**2) / (1 + c * low**2))
        if moved < 10 * EPS ** (1 / 3) and abs(low - 1) < 10 * EPS:
            break
    return x


def divide(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces of ``a``, the larger eigenvalues' first; None if all are equal."""
    size, norm = len(a), np.linalg.norm(a)
    mean = np.trace(a) / size
    spread = np.linalg.norm(a - mean * np.eye(size))
    if spread <= 4 * EPS * size * norm:
        return None
    best = None
    # the mean has eigenvalues on either side; next to it are shifts in case it is an eigenvalue itself
    for step in (0.0, 0.01, -0.01, 0.037, -0.037, 0.11, -0.11, 0.003, -0.003):
        shift = mean + step * spread / np.sqrt(size)
        u = polar(a - shift * np.eye(size))
        if u is None:
            continue
        projector = (u + np.eye(size)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < size:
            continue
        start = np.argsort(-np.diag(projector), kind="stable")[:rank]
        q, _ = np.linalg.qr(projector[:, start], mode="complete")
        for _ in range(2):
            q, _ = np.linalg.qr(np.hstack([projector @ q[:, :rank], q[:, rank:] - projector @ q[:, rank:]]))
        upper, lower = q[:, :rank], q[:, rank:]
        left = np.linalg.norm(lower.T @ a @ upper)
        if best is None or left < best[0]:
            best = left, upper, lower
        if left <= 50 * EPS * norm:
            break
    return best and (best[1], best[2])


def spectral(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and the unit eigenvectors, as columns, of a symmetric matrix."""
    values, vectors = np.zeros(len(a)), np.zeros_like(a, dtype=float)
    todo = [(0, np.eye(len(a)))] if len(a) else []
    while todo:
        at, basis = todo.pop()
        part = basis.T @ a @ basis
        split = divide((part + part.T) / 2) if len(part) > 1 else None
        if split is None:
            values[at : at + len(part)] = np.diag(part)
            vectors[:, at : at + len(part)] = basis
            continue
        upper, lower = (basis @ half for half in split)
        todo += [(at, upper), (at + upper.shape[1], lower)]
    # errors of the parts, of the order of rounding, are taken out by one orthogonal correction of first order
    vectors, _ = np.linalg.qr(vectors)
    rest = vectors.T @ a @ vectors
    values = np.diag(rest).copy()
    gap = values[None, :] - values[:, None]
    small = np.abs(rest) < 1e-6 * np.abs(gap)
    turn = np.where(small & (gap != 0), rest / np.where(gap == 0, 1, gap), 0)
    np.fill_diagonal(turn, 0)
    vectors, r = np.linalg.qr(vectors + vectors @ turn)
    vectors *= np.sign(np.diag(r))
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# --- rows ---------------------------------------------------------------------------------------


def integers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of their integers) for each length of usable vectors in a column of lists."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.zeros(len(column), np.int64) if not len(column) else np.diff(column.offsets.to_numpy()).astype(np.int64)
    there = column.is_valid().to_numpy(zero_copy_only=False)
    entries = column.values.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    begins = column.offsets.to_numpy()[:-1]
    for size in np.unique(sizes[there & (sizes > 0)]).tolist():
        rows = np.flatnonzero(there & (sizes == size))
        block = entries[begins[rows][:, None] + np.arange(size)]
        with np.errstate(invalid="ignore"):
            fine = (np.abs(block) < LARGEST).all(axis=1)
        if fine.any():
            yield rows[fine], np.floor(block[fine] * SCALE).astype(np.int64) + OFFSET


def products(block: np.ndarray) -> np.ndarray:
    """Exact block.T @ block, as Python integers."""
    size = max(1, int(np.abs(block).max(initial=0)) ** 2)
    if size >= EXACT:
        wide = block.astype(object)
        return wide.T @ wide
    rows, total = max(1, EXACT // size), np.zeros((block.shape[1],) * 2, object)
    for at in range(0, len(block), rows):
        part = block[at : at + rows].astype(float)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _partial(vectors: DataFrame, schema: str, add, rows_of) -> DataFrame:
    """One partial sum per task and key: ``add(state, matrix)`` over its matrices, ``rows_of(state)`` as columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            for _, block in integers(batch.column(0)):
                add(state, block)
        yield rows_of(state)

    return vectors.mapInArrow(run, schema)


@dataclass(frozen=True)
class Whitening:
    """What the fit gives: the number of vectors, exact sums, components (rows) with eigenvalues and shares, the error."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float


def first_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of usable vectors of the most frequent length, and their sums by dimension."""

    def add(state: dict, block: np.ndarray) -> None:
        n, sums = state.get(block.shape[1], (0, 0))
        state[block.shape[1]] = n + len(block), sums + block.sum(axis=0, dtype=object)

    def rows_of(state: dict) -> pa.RecordBatch:
        keys = [(size, i, n, Decimal(int(total))) for size, (n, sums) in state.items() for i, total in enumerate(sums)]
        columns = list(zip(*keys, strict=True)) or [[]] * 4
        kinds = pa.int64(), pa.int64(), pa.int64(), SUM
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["size", "i", "n", "total"])

    parts = _partial(vectors, "size long, i long, n long, total decimal(38,0)", add, rows_of)
    sums = parts.groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")).persist()
    try:
        first = sums.filter("i = 0").orderBy(F.col("n").desc(), F.col("size").desc()).first()
        if first is None:
            return 0, []
        found = sums.filter(F.col("size") == first["size"]).orderBy("i").collect()
    finally:
        sums.unpersist()
    return first["n"], [int(r["total"]) for r in found]


def pair_sums(vectors: DataFrame, dims: int, make, kind: pa.DataType, sql: str) -> list:
    """Sums over all usable rows of the products that ``make`` gives for each block, one for each pair of dimensions."""

    def add(state: dict, block: np.ndarray) -> None:
        if block.shape[1] == dims:
            made = make(block)
            state["sum"] = state["sum"] + made if state else made

    def rows_of(state: dict) -> pa.RecordBatch:
        if not state:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], kind)], names=["i", "j", "total"])
        i, j = np.triu_indices(len(state["sum"]))
        totals = state["sum"][i, j].tolist()
        exact = pa.types.is_decimal(kind)
        return pa.RecordBatch.from_arrays([
            pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array([Decimal(int(t)) for t in totals] if exact else totals, kind),
        ], names=["i", "j", "total"])

    parts = _partial(vectors, f"i long, j long, total {sql}", add, rows_of)
    return parts.groupBy("i", "j").agg(F.sum("total").cast(sql).alias("total")).collect()


def fit_whitening(rows: DataFrame, vector: str = "embedding", most: int = 32) -> Whitening:
    bound_batches(rows.sparkSession)
    vectors = rows.select(vector)
    n, sums = first_sums(vectors)
    dims = len(sums)
    if not n:
        return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.0)
    near = [s // n for s in sums]
    centre = np.array(near, np.int64)
    total = pair_sums(vectors, dims, lambda block: products(block - centre), SUM, "decimal(38,0)")
    rest = [s - n * m for s, m in zip(sums, near, strict=True)]
    covariance = np.zeros((dims, dims))
    for i, j, t in total:
        covariance[i, j] = covariance[j, i] = float(Fraction(n * int(t) - rest[i] * rest[j], n * n))
    values, vectors_ = spectral(covariance)
    kept = min(most, int((values > 1e-12 * max(values[0], 0)).sum()))
    if not kept:
        return Whitening(n, tuple(sums), np.zeros((0, dims)), np.zeros(0), np.zeros(0), 0.0)
    components, values_ = np.ascontiguousarray(vectors_[:, :kept].T), values[:kept]
    explained = values_ / np.trace(covariance)
    fit = Whitening(n, tuple(sums), components, values_, explained, 0.0)

    def products_of(block: np.ndarray) -> np.ndarray:
        w = whitened(fit, centred(fit, block))
        return w.T @ w

    found = pair_sums(vectors, dims, products_of, pa.float64(), "double")
    error = max(abs(t / n - (i == j)) for i, j, t in found)
    return Whitening(n, tuple(sums), components, values_, explained, float(error))


def centred(fit: Whitening, block: np.ndarray) -> np.ndarray:
    """n x - S, exact: as 64-bit integers where they fit, else as Python integers."""
    if fit.n * (int(np.abs(block).max(initial=0)) + 1) < 1 << 61 and max(map(abs, fit.sums)) < 1 << 61:
        return block * fit.n - np.array(fit.sums, np.int64)
    return block.astype(object) * fit.n - np.array(fit.sums, object)


def whitened(fit: Whitening, apart: np.ndarray) -> np.ndarray:
    return (apart / fit.n).astype(float) @ (fit.components / np.sqrt(fit.values)[:, None]).T


def deviations(apart: np.ndarray) -> list[int | None]:
    if apart.dtype != object and int(np.abs(apart).max(initial=0)) ** 2 * apart.shape[1] < 1 << 63:
        return (apart**2).sum(axis=1).tolist()
    return [d if d < 1 << 63 else None for d in (apart.astype(object) ** 2).sum(axis=1).tolist()]


def whiten(rows: DataFrame, fit: Whitening, key: str = "vec_id", vector: str = "embedding", slice_rows: int = 4096) -> DataFrame:
    """One row per usable row and component: key, component from 1, n, deviation, whitened, explained, identity_error."""
    from pyspark.sql.pandas.types import to_arrow_schema

    count, dims = fit.components.shape
    schema = T.StructType([
        T.StructField(key, rows.schema[key].dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")],
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(schema)
        for batch in batches if count else ():
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                for places, block in integers(part.column(1)):
                    if block.shape[1] != dims:
                        continue
                    apart, made = centred(fit, block), len(block)
                    times = np.repeat(np.arange(made), count)
                    yield pa.RecordBatch.from_arrays([
                        part.column(0).take(pa.array(places[times])), pa.array(np.tile(np.arange(1, count + 1), made), pa.int32()),
                        pa.array(np.full(made * count, fit.n), pa.int64()), pa.array(deviations(apart), pa.int64()).take(pa.array(times)),
                        pa.array(whitened(fit, apart).ravel()), pa.array(np.tile(fit.explained, made)),
                        pa.array(np.full(made * count, fit.identity_error)),
                    ], schema=out)

    return rows.select(key, vector).mapInArrow(run, schema)
