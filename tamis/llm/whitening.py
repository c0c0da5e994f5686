"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

With X the centred rows, the method builds right vectors v and left vectors u in turn from the products Xv and X'u, both
orthogonalised against all before them, so that X V = U B with a small upper bidiagonal B. The singular values of B give the
deviations of the components, V times its right vectors the components.

A left vector has an entry per row, but it is always X times a vector of the rows' dimension. It is kept as that vector p
(u = X p) together with X'u, so inner products of left vectors need no pass: the product of u and X v is p'(X'X v). A step
is then one pass over the rows, in which a task multiplies its rows by v and adds up the rows times the products; the sums
are added by dimension. The driver holds vectors of the rows' dimension only.

Steps end when the residuals of the wanted components are at the rounding level and the variance outside the Krylov space
is below the smallest of them, so no direction that is left can be larger; at the latest after as many steps as there are
dimensions. A vector that breaks down is replaced by a random one orthogonal to those before, so equal eigenvalues are found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
LARGEST = float(1 << 30)  # entries beyond are treated like infinite ones
EPS = float(np.finfo(np.float64).eps)
LEAST = 1e-11  # of the largest eigenvalue; smaller ones are rounding
STEP = 4096
LONG = 1 << 63


@dataclass
class Fit:
    """``sums`` of ``n`` rows, ``components`` (one per row) with their ``eigenvalues``, and ``trace`` of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    steps: int


def exact_rows(vectors: DataFrame, vector_col: str, own: list) -> DataFrame:
    """``own`` columns and ``x``, a list of longs, of the rows that can be fitted."""
    v = F.col(vector_col)
    # A null entry makes forall null or false, and the row goes.
    usable = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < LARGEST))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    return vectors.filter(usable).select(*own, x.alias("x"))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            some = batch.slice(at, STEP)
            yield some, np.asarray(some.column("x").flatten()).reshape(some.num_rows, -1)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Rows less their mean; the whole part is taken off exactly."""
    whole = sums // n
    return (x - whole).astype(np.float64) - (sums - whole * n) / n


def added(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> list:
    """Sum of ``of(block)`` over all blocks, by place: one partial list per task, added by Spark."""
    entry, dtype = (pa.float64(), np.float64) if kind == "double" else (pa.int64(), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in blocks(batches):
            part = of(x)
            total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch({"part": pa.array([total.astype(dtype)], pa.list_(entry))})

    wide = "double" if kind == "double" else "decimal(38,0)"
    parts = rows.select("x").mapInArrow(run, f"part array<{kind}>").select(F.posexplode("part").alias("at", "value"))
    found = parts.groupBy("at").agg(F.sum(F.col("value").cast(wide)).alias("value")).collect()  # one row per place
    return [r["value"] for r in sorted(found, key=lambda r: r["at"])]


def bidiagonalise(multiply: Callable[[np.ndarray], np.ndarray], size: int, total: float, wanted: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Largest singular values and right vectors (one per row) of X, from ``multiply``: v -> X'Xv; ``total`` is X's squared norm."""
    random = np.random.RandomState(20240701)
    v_all, p_all, z_all = (np.zeros((0, size)) for _ in range(3))
    alphas, betas = [], []

    def orthogonal(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - v_all.T @ (v_all @ v)
        return v

    scale = np.sqrt(total)
    rest = random.standard_normal(size)
    beta = 0.0
    while True:
        v = rest / np.linalg.norm(rest)
        v_all = np.vstack([v_all, v])
        p, z = v, multiply(v)
        for _ in range(2):  # u = Xv less its part along the left vectors so far
            along = p_all @ z
            p, z = p - p_all.T @ along, z - z_all.T @ along
        alpha = np.sqrt(max(0.0, float(p @ z)))
        if alpha <= 64 * EPS * scale:
            alpha, p, z = 0.0, np.zeros(size), np.zeros(size)
        else:
            p, z = p / alpha, z / alpha
        p_all, z_all = np.vstack([p_all, p]), np.vstack([z_all, z])
        alphas.append(alpha)
        k = len(alphas)
        left, sigma, right = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        if k == size:
            break
        rest = orthogonal(z - alpha * v)
        beta = float(np.linalg.norm(rest))
        if beta <= 64 * EPS * scale:
            beta, rest = 0.0, orthogonal(random.standard_normal(size))
        outside = total - float(np.sum(np.square(alphas)) + np.sum(np.square(betas)))
        at = min(wanted, k)
        settled = np.abs(beta * left[-1, :at]) <= 16 * EPS * sigma[0]
        if (k >= wanted and settled.all() and outside <= sigma[at - 1] ** 2) or outside <= 1e-14 * total and settled.all():
            break
        betas.append(beta)
    sigma, found = sigma[:wanted], right[:wanted] @ v_all
    while len(sigma) < min(wanted, size):  # nothing is left outside: the other values are 0
        rest = orthogonal(random.standard_normal(size))
        rest /= np.linalg.norm(rest)
        v_all, found, sigma = np.vstack([v_all, rest]), np.vstack([found, rest]), np.append(sigma, 0.0)
    return sigma, found, len(alphas)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The fit over all ``rows`` (column ``x``, lists of one length); none without rows."""
    ends = added(rows, lambda x: np.append(x.sum(axis=0), len(x)), "long")
    if not ends or not ends[-1]:
        return None
    sums, n = [int(s) for s in ends[:-1]], int(ends[-1])
    mean = np.array([s // n for s in sums], np.int64)
    left = np.array([s % n for s in sums], np.float64) / n

    def spread(x: np.ndarray) -> np.ndarray:
        return (x - mean).astype(np.float64) - left

    def multiply(v: np.ndarray) -> np.ndarray:
        return np.array(added(rows, lambda x: (y := spread(x)).T @ (y @ v)))

    total = added(rows, lambda x: np.array([np.square(spread(x)).sum()]))[0]
    if total <= 0:
        return Fit(n, sums, np.zeros((0, len(sums))), np.zeros(0), 0.0, 0)
    sigma, vectors, steps = bidiagonalise(multiply, len(sums), total, min(components, len(sums)))
    keep = sigma**2 > LEAST * sigma[0] ** 2
    vectors = vectors[keep] / np.linalg.norm(vectors[keep], axis=1, keepdims=True)
    vectors *= np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])[:, None]
    return Fit(n, sums, vectors, sigma[keep] ** 2 / n, total / n, steps)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums over dimensions of (n * x - sum) ** 2, exact; null where a long cannot hold it."""
    whole, left = np.array([s // n for s in sums], np.int64), [s % n for s in sums]
    a = x - whole
    if int(np.abs(a).max(initial=0)) < 1 << 26:
        squares = np.square(a).sum(axis=1).tolist()
    else:
        squares = [sum(int(v) ** 2 for v in row) for row in a]
    if n < 1 << 20 and int(np.abs(a).max(initial=0)) < 1 << 31:
        mixed = (a * np.array(left, np.int64)).sum(axis=1).tolist()
    else:
        mixed = [sum(int(v) * r for v, r in zip(row, left)) for row in a]
    const = sum(r * r for r in left)
    found = [n * n * s - 2 * n * m + const for s, m in zip(squares, mixed)]
    return [d if d < LONG else None for d in found]


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id``, ``component`` from 1, ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    One row per vector that is left and component with an eigenvalue above 1e-11 of the largest: no more components than
    ``components`` or the rank, and no rows if all vectors are equal. Vectors are left out that are null, empty, hold a null,
    infinite or undefined entry or one of 2 ** 30 or more, or have another length than most (of equally frequent lengths
    the longest counts). Repeated rows and null ids count and stay like others. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = written(exact_rows(vectors, vector_col, [F.col(id_col).alias("vec_id")]).filter(F.size("x") > 0), "vectors")
    shape = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    size = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    found = fit(rows.filter(F.size("x") == size["size"]), components) if size else None
    if found is None or not len(found.eigenvalues):
        return spark.createDataFrame([], shape)
    rows = rows.filter(F.size("x") == size["size"])
    n, sums = found.n, found.sums
    mean = np.array([s // n for s in sums], np.int64)
    left = np.array([s % n for s in sums], np.float64) / n
    project = (found.components / np.sqrt(found.eigenvalues)[:, None]).T
    many = project.shape[1]

    def whitened(x: np.ndarray) -> np.ndarray:
        return ((x - mean).astype(np.float64) - left) @ project

    moments = added(rows, lambda x: np.concatenate([(w := whitened(x)).sum(axis=0), (w.T @ w).ravel()]))
    first, second = np.array(moments[:many]) / n, np.array(moments[many:]).reshape(many, many) / n
    error = float(np.abs(second - np.outer(first, first) - np.eye(many)).max())
    explained = found.eigenvalues / found.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, x in blocks(batches):
            for at in range(0, len(x), max(1, (1 << 16) // many)):
                part = x[at:at + max(1, (1 << 16) // many)]
                rows_of = np.repeat(np.arange(len(part)), many)
                yield pa.record_batch({
                    "vec_id": some.column("vec_id").slice(at, len(part)).take(pa.array(rows_of)),
                    "component": pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(part))),
                    "n": pa.array(np.full(len(rows_of), n, np.int64)),
                    "deviation": pa.array(deviations(part, n, sums), pa.int64()).take(pa.array(rows_of)),
                    "whitened": pa.array(whitened(part).ravel()),
                    "explained": pa.array(np.tile(explained, len(part))),
                    "identity_error": pa.array(np.full(len(rows_of), error))})

    return rows.mapInArrow(run, shape)
