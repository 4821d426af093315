"""Embedding whitening by spectral divide and conquer.

The covariance is gathered in two passes over the vectors (means first, then products of centred
entries); it has one row per dimension, whatever the number of vectors.  Its eigenvectors come
from QDWH: the polar factor U of the covariance shifted by s is the sign of the shifted matrix, so
(U + I) / 2 projects on the span of all eigenvectors above s.  The span and its complement are
split again, each at a shift of its own, until every block is one component.  The few components
asked for are sent to all tasks, which whiten their own rows.

Entries are taken as whole numbers, floor(1024 c) + 100000, so counts, sums and deviations are exact.

Defined cases: a vector that is null, empty or holds a null, NaN or infinite entry takes no part, nor does one
whose length differs from most; a row without an id is whitened like any other; repeated rows count each
and give a row each; a component without variance (constant columns, fewer vectors than dimensions)
has no whitened value (null) and explains 0; an empty table gives an empty table; long vectors cost
dimensions squared per task; only the id and the vector are read, so other columns cannot clash.
Entries beyond 2**40 in absolute value are not exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordforge.llm.vectors import comparable, finite_vector, matrix, summed

EPS = np.finfo(float).eps
SCHEMA = ("{id} {kind}, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


# -- the decomposition (matrices of dimensions x dimensions) --------------------------------------

def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a square matrix by QDWH iteration.

    The weights follow a lower bound of the smallest singular value; while it is small a step goes
    through a QR factorisation, afterwards through a Cholesky one.
    """
    size = len(a)
    x = a / max(np.sqrt(np.linalg.norm(a, 1) * np.linalg.norm(a, np.inf)), np.finfo(float).tiny)
    low, eye = EPS, np.eye(size)
    for _ in range(30):
        if abs(1 - low) < 4 * EPS:
            break
        d = np.cbrt(4 * (1 - low ** 2) / low ** 4)
        wa = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low ** 2) / (low ** 2 * np.sqrt(1 + d)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            x = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:size] @ q[size:].T)
        else:
            c = np.linalg.cholesky(eye + wc * (x.T @ x))
            half = np.linalg.solve(c, x.T)
            x = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(c.T, half).T
        low = min(1.0, low * (wa + wb * low ** 2) / (1 + wc * low ** 2))
    return x


def _split(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenvectors above and below ``shift``; None if one side is empty or they mix."""
    size = len(a)
    u = polar_factor(a - shift * np.eye(size))
    projector = (u + u.T) / 4 + np.eye(size) / 2
    above = int(round(np.trace(projector)))
    if not 0 < above < size:
        return None
    upper, _ = np.linalg.qr(projector @ rng.standard_normal((size, above)))
    basis, _ = np.linalg.qr(projector @ upper, mode="complete")
    upper, lower = basis[:, :above], basis[:, above:]
    mixed = np.linalg.norm(lower.T @ a @ upper)
    return (upper, lower) if mixed <= 1e3 * EPS * size * max(np.linalg.norm(a), np.finfo(float).tiny) else None


def components(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    Only blocks that hold wanted components are split further.
    """
    rng = np.random.default_rng(42)

    def solve(block: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        size = len(block)
        off = block - np.diag(np.diag(block))
        if size == 1 or np.linalg.norm(off) <= EPS * np.linalg.norm(block):  # one component, or all of them along the axes
            order = np.argsort(-np.diag(block), kind="stable")[:most]
            return np.diag(block)[order], np.eye(size)[:, order]
        diagonal = np.sort(np.diag(block))
        # a shift strictly inside the spectrum: the mean always is, others are tried if it meets an eigenvalue
        middle = np.trace(block) / size
        spread = np.linalg.norm(block - middle * np.eye(size)) / np.sqrt(size)
        for shift in (float(np.median(diagonal)), middle, *(middle + spread * t for t in (0.1, -0.1, 0.31, -0.31, 0.03, -0.03, 0.007, -0.007))):
            bases = _split(block, shift, rng)
            if bases is not None:
                break
        else:  # the eigenvalues differ by rounding only: any basis will do
            return np.sort(np.diag(block))[::-1][:most], np.eye(size)[:, np.argsort(-np.diag(block), kind="stable")[:most]]
        values, vectors = [], []
        for basis in bases:
            left = most - sum(map(len, values))
            if left > 0:
                inner = basis.T @ block @ basis
                e, v = solve((inner + inner.T) / 2, left)
                values.append(e)
                vectors.append(basis @ v)
        return np.concatenate(values), np.hstack(vectors)

    e, v = solve((a + a.T) / 2, wanted)
    order = np.argsort(-e, kind="stable")
    e, v = e[order], v[:, order]
    v = v / np.linalg.norm(v, axis=0)
    signs = np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])
    return e, v * signs


# -- over the table -----------------------------------------------------------------------------

def _whole(rows: np.ndarray, scale: int, offset: int) -> np.ndarray:
    return np.floor(scale * rows) + offset


def _exact_sums(rows: np.ndarray) -> np.ndarray:
    """Column sums as Python ints; the high and the low 20 bits are added apart, so each partial sum is exact."""
    high = np.floor_divide(rows, 1 << 20)
    low = rows - high * (1 << 20)
    return np.array([int(h) * (1 << 20) + int(x) for h, x in zip(high.sum(axis=0), low.sum(axis=0))], dtype=object)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2, exact; None if it does not fit in a long."""
    whole = x.astype(np.int64)
    span = int(np.abs(whole).max(initial=0)) * n + max(map(abs, sums), default=0)
    if span ** 2 * len(sums) < 1 << 62:  # products fit
        gaps = whole * n - np.array(sums, dtype=np.int64)
        return (gaps * gaps).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in whole.tolist()]
    return [d if d < 1 << 63 else None for d in exact]


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", wanted: int = 8,
           scale: int = 1024, offset: int = 100_000) -> DataFrame:
    """One row per vector and component: id, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    rows, dims = comparable(df.select(F.col(id_col), finite_vector(F.col(vec_col)).alias("__vec")), "__vec")
    schema = SCHEMA.format(id=f"`{id_col}`", kind=df.schema[id_col].dataType.simpleString())
    if not dims:
        return df.sparkSession.createDataFrame([], schema)
    *sums, n = summed(rows, lambda m: np.append(_exact_sums(_whole(m, scale, offset)), len(m)), dims + 1, "__vec", dims, exact=True)
    means = np.array([s / n for s in sums])  # correctly rounded quotients of whole numbers

    def products(m: np.ndarray) -> np.ndarray:
        centred = _whole(m, scale, offset) - means
        return (centred.T @ centred).ravel()

    covariance = np.array(summed(rows, products, dims * dims, "__vec", dims)).reshape(dims, dims) / n
    e, v = components(covariance, wanted)
    trace = float(np.trace(covariance))
    alive = e > dims * EPS * max(trace, 0.0)
    axes = v / np.sqrt(np.where(alive, e, np.nan))
    explained = np.where(alive, e / trace if trace > 0 else 0.0, 0.0)
    live = int(alive.sum())

    def whitened_products(m: np.ndarray) -> np.ndarray:
        w = (_whole(m, scale, offset) - means) @ axes[:, alive]
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    error = 0.0
    if live:
        got = np.array(summed(rows, whitened_products, live * (live + 1), "__vec", dims)) / n
        centre = got[live * live:]
        error = float(np.abs(got[:live * live].reshape(live, live) - np.outer(centre, centre) - np.eye(live)).max())
    count = len(e)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            x = _whole(matrix(batch.column(1), dims), scale, offset)
            w = ((x - means) @ axes).ravel()
            each = np.repeat(np.arange(size), count)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), size)),
                pa.array(np.full(size * count, n)),
                pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(each)),
                pa.array(w, mask=np.isnan(w)),
                pa.array(np.tile(explained, size)),
                pa.array(np.full(size * count, error)),
            ], [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(id_col, "__vec").mapInArrow(project, schema)
