"""Whitening of embeddings onto their leading principal components.

1. Entries become integers, floor(scale * entry). The fit list is every
   distinct integer vector once: n vectors with sums S (exact).
2. Spark adds up centred products per partition, x - S/n first, and then the
   partitions' sums: the covariance V (divisor n), d * d numbers.
3. On the driver, for one d * d matrix: Householder reflections bring V into
   tridiagonal form; Sturm counts and bisection give the leading eigenvalues;
   inverse iteration gives their vectors, reorthogonalised within a cluster of
   close eigenvalues, and the reflections take them back.
4. The projection (d * components numbers) is broadcast; every row is projected
   and divided by the root of the eigenvalue.

A row takes part if its vector is not null and holds neither nulls nor
non-finite entries, nor is empty. All vectors should have one length; the
commonest (of equally common ones the longest) is the one that is fitted, and
rows of another length are left out. Rows repeat as often as they are given;
a null id is a value like any other. Components with an eigenvalue of zero
(within rounding of the trace) don't exist, so there may be fewer than asked
for: none for an empty table or if all vectors are equal. A deviation beyond
64 bits is null. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import stored

SCALE = 256
#: Eigenvalues closer than this share of the matrix' norm form a cluster.
CLUSTER = 1e-3
#: Eigenvalues up to this multiple of the trace count as zero.
ZERO = 1e-12


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * entry) of each entry; null for vectors that take no part."""
    numbers = F.transform(vector, lambda c: c.cast("double"))
    sound = F.forall(numbers, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(numbers, lambda c: F.floor(c * F.lit(float(scale))))
    return F.when(F.coalesce(sound & (F.size(vector) > 0), F.lit(False)), x)


# --- one symmetric matrix ---------------------------------------------------


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, subdiagonal and the orthogonal q of v = q t q', by Householder reflections."""
    a = np.array(v, dtype=np.float64)
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            continue
        x[0] += np.copysign(size, x[0])
        x /= np.linalg.norm(x)
        p = a[k + 1 :, k + 1 :] @ x
        w = p - (x @ p) * x
        a[k + 1 :, k + 1 :] -= 2 * (np.outer(x, w) + np.outer(w, x))
        a[k + 1 :, k] -= 2 * x * (x @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def count_below(d: np.ndarray, e: np.ndarray, x: float) -> int:
    """Number of eigenvalues of the tridiagonal matrix below ``x`` (Sturm sequence)."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count, pivot = 0, 1.0
    for k in range(len(d)):
        pivot = d[k] - x - (e[k - 1] ** 2 / pivot if k else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot < 0
    return count


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> list[float]:
    """The ``k`` largest eigenvalues, falling, each by bisection down to neighbouring doubles."""
    n = len(d)
    beside = np.abs(np.r_[0.0, e]) + np.abs(np.r_[e, 0.0])
    low, high = float(np.min(d - beside)), float(np.max(d + beside))
    margin = np.finfo(float).eps * max(abs(low), abs(high)) * n + np.finfo(float).tiny
    found = []
    for j in range(min(k, n)):
        a, b = low - margin, high + margin
        while True:
            m = (a + b) / 2
            if not a < m < b:
                break
            if count_below(d, e, m) > n - 1 - j:  # the wanted one is below m
                b = m
            else:
                a = m
        found.append((a + b) / 2)
    return found


def _factors(d: np.ndarray, e: np.ndarray, x: float, small: float):
    """LU of t - x with row exchanges: diagonal, two upper diagonals, multipliers, exchanges."""
    n = len(d)
    u, v, w = d - x, np.r_[e, 0.0], np.zeros(n)
    mult, swap = np.zeros(n), np.zeros(n, dtype=bool)
    for k in range(n - 1):
        below, right = e[k], d[k + 1] - x
        over = e[k + 1] if k + 2 < n else 0.0
        if abs(below) > abs(u[k]):
            swap[k] = True
            m = u[k] / below
            top = v[k]
            u[k], v[k], w[k] = below, right, over
            u[k + 1], v[k + 1] = top - m * right, -m * over
        else:
            m = below / u[k] if u[k] else 0.0
            u[k + 1], v[k + 1] = right - m * v[k], over
        mult[k] = m
    u[np.abs(u) < small] = small
    return u, v, w, mult, swap


def _solve(factors, y: np.ndarray) -> np.ndarray:
    u, v, w, mult, swap = factors
    n, y = len(u), y.copy()
    for k in range(n - 1):
        if swap[k]:
            y[k], y[k + 1] = y[k + 1], y[k]
        y[k + 1] -= mult[k] * y[k]
    for k in range(n - 1, -1, -1):
        y[k] = (y[k] - (v[k] * y[k + 1] if k + 1 < n else 0.0) - (w[k] * y[k + 2] if k + 2 < n else 0.0)) / u[k]
    return y


def eigenvectors(d: np.ndarray, e: np.ndarray, values: list[float]) -> np.ndarray:
    """Unit vectors (columns) of the tridiagonal matrix for falling ``values``."""
    n = len(d)
    norm = max(float(np.max(np.abs(d) + np.abs(np.r_[0.0, e]) + np.abs(np.r_[e, 0.0]))), np.finfo(float).tiny)
    eps = np.finfo(float).eps
    out, start, used = np.zeros((n, len(values))), 0, None
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            start = j
        shift = value
        if j > start and used - shift < 10 * eps * norm:
            shift = used - 10 * eps * norm  # equal values need shifts of their own
        used = shift
        factors = _factors(d, e, shift, eps * norm)
        y = np.random.default_rng(j).uniform(-1, 1, n)
        for _ in range(6):
            for _ in range(2):
                y = y - out[:, start:j] @ (out[:, start:j].T @ y)
            y /= np.linalg.norm(y)
            y = _solve(factors, y)
            y /= np.max(np.abs(y))
        for _ in range(2):
            y = y - out[:, start:j] @ (out[:, start:j].T @ y)
            y /= np.linalg.norm(y)
        out[:, j] = y
    return out


def principal(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` leading eigenvalues, falling, and their unit vectors as columns.

    Of the two signs the one that makes the largest entry positive.
    """
    scale = float(np.max(np.abs(v), initial=0)) or 1.0
    d, e, q = tridiagonal(v / scale)
    values = leading_eigenvalues(d, e, k)
    vectors = q @ eigenvectors(d, e, values)
    vectors /= np.linalg.norm(vectors, axis=0)
    largest = vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])]
    return np.array(values) * scale, vectors * np.where(largest < 0, -1.0, 1.0)


# --- over all rows ----------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """n and sums of the fit list; eigenvalues, unit vectors (d rows) and trace; largest error of the identity."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _added(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sum of arrays by row number: ``parts`` has (i, v array<double>) of every partition."""
    cells = parts.select("i", F.posexplode("v").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    rows = cells.groupBy("i").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "x"))), lambda c: c["x"]).alias("v"))
    return {r["i"]: np.array(r["v"]) for r in rows.collect()}


def _products(d: int, mean: np.ndarray, matrix: np.ndarray):
    """A task's sum of outer products of (x - mean) matrix, and after them its sum of (x - mean) matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = matrix.shape[1]
        total = np.zeros((k + 1, k))
        for batch in batches:
            y = (_matrix(batch.column(0), d) - mean) @ matrix
            total[:k] += y.T @ y
            total[k] += y.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(k + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "v"])

    return run


def _exact_sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = [0] * d, 0
        for batch in batches:
            x = _matrix(batch.column(0), d)
            if float(np.max(np.abs(x.astype(float)), initial=0)) * max(1, len(x)) < 2.0**62:
                sums = x.sum(axis=0).tolist()
            else:
                sums = x.astype(object).sum(axis=0).tolist()
            total = [a + b for a, b in zip(total, sums, strict=True)]
            rows += len(x)
        cells = [str(s) for s in [*total, rows]]
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array(cells)], ["j", "s"])

    return run


def fit(vectors: DataFrame, components: int = 4, vector: str = "embedding", scale: int = SCALE) -> Whitening | None:
    """The whitening of all distinct integer vectors; None if no row takes part."""
    x = vectors.select(integers(F.col(f"`{vector}`"), scale).alias("x")).where("x IS NOT NULL")
    longest = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not longest:
        return None
    d = longest[0]["d"]
    listed = stored(x.where(F.size("x") == d).distinct(), "whitening-list")
    sums = listed.mapInArrow(_exact_sums(d), "j int, s string").groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    exact = {r["j"]: int(r["s"]) for r in sums.collect()}
    n = exact[d]
    mean = np.array([float(Fraction(exact[j], n)) for j in range(d)])
    cells = "i int, v array<double>"
    centred = _added(listed.mapInArrow(_products(d, mean, np.eye(d)), cells))
    v = np.array([centred[i] for i in range(d)]) / n
    v = (v + v.T) / 2
    trace = float(np.trace(v))
    values, units = principal(v, components)
    real = values > ZERO * max(trace, 0.0)
    values, units = values[real], units[:, real]
    error = 0.0
    if len(values):
        k = len(values)
        white = _added(listed.mapInArrow(_products(d, mean, units / np.sqrt(values)), cells))
        shift = white[k] / n
        cov = np.array([white[i] for i in range(k)]) / n - np.outer(shift, shift)
        error = float(np.max(np.abs(cov - np.eye(k))))
    return Whitening(n, tuple(exact[j] for j in range(d)), values, units, trace, error)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    reach = n * float(np.max(np.abs(x.astype(float)), initial=0)) + max(abs(s) for s in sums)
    if len(sums) * reach**2 < 2.0**62:
        return ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    wide = ((n * x.astype(object) - np.array(sums, dtype=object)) ** 2).sum(axis=1).tolist()
    return [w if w < 2**63 else None for w in wide]


def whiten(model: Whitening | None, vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Per row that takes part and component (from 1): id, component, n, deviation, whitened, explained, identity_error."""
    id_type = vectors.schema[id_col].dataType
    tail = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    schema = T.StructType([T.StructField(id_col, id_type), *T.StructType.fromDDL(tail).fields])
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    d, k = len(model.sums), len(model.values)
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        mean, projection = m.mean, m.projection
        for batch in batches:
            x = _matrix(batch.column(1), d)
            rows = len(x)
            white = (x - mean) @ projection
            of_row = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(of_row),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, m.n, dtype=np.int64)),
                    pa.array(_deviations(x, m.n, m.sums), pa.int64()).take(of_row),
                    pa.array(white.ravel()),
                    pa.array(np.tile(m.values / m.trace, rows)),
                    pa.array(np.full(rows * k, m.identity_error)),
                ],
                schema.names,
            )

    rows = vectors.select(F.col(f"`{id_col}`"), integers(F.col(f"`{vector}`"), scale).alias("x")).where(F.size("x") == d)
    return rows.mapInArrow(run, schema)
