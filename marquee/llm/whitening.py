"""Embedding whitening: principal components by QDWH spectral divide and conquer.

1. Vectors become integers ``x``; the fit list holds every distinct one once.
2. Two passes of partial sums over the fit list: count and sums, then the
   products of the integers less the rounded-down mean. All sums are exact,
   so the covariance is exact before it is turned into doubles.
3. On the driver, which holds one matrix of dimensions x dimensions: the polar
   factor of the covariance less a shift (QDWH: dynamically weighted Halley
   steps, by QR while ill-conditioned, then by Cholesky) is +1 on the
   eigenvectors above the shift and -1 below. It gives the projector onto
   each of the two invariant subspaces; both halves are split on, until they
   are of one dimension or a multiple of the identity.
4. The components (dimensions x 16 numbers) travel in the task closure and
   whiten every row; a further pass over the fit list measures what is left
   between the covariance of the whitened vectors and the identity.

Defined cases:

* null vectors and vectors with null or non-finite entries are dropped, as
  are vectors of another length than the most frequent one (ties: the longer);
* fewer than 16 dimensions: as many components; a component without variance
  (one distinct vector, constant or dependent dimensions) has whitened 0, and
  is left out of the identity error; explained is 0 where nothing varies;
* equal eigenvalues: some orthonormal basis of their space, the same for all rows;
* repeated vectors count once in the fit; every row is returned, null and
  repeated ids included; empty table: no rows; there are no texts;
* extra columns are not read, whatever their names;
* a deviation beyond a long (over 10^7 distinct vectors) is an error in the
  report; the operator's own column is decimal(38, 0).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import vectors as V
from marquee.session import materialized

SCALE = 64
OFFSET = 1_000_000
N_COMPONENTS = 16
EPS = np.finfo(np.float64).eps


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix: its matrix sign."""
    n = len(a)
    x = a / np.linalg.norm(a)
    low, eye = EPS / n, np.eye(n)  # lower bound of the singular values; a cautious one only costs a step
    for _ in range(40):
        l2 = low * low
        d = np.cbrt(4 * (1 - l2) / (l2 * l2))
        root = np.sqrt(1 + d)
        w = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - l2) / (l2 * root), 0.0))
        v = (w - 1) ** 2 / 4
        c = w + v - 1
        if c > 100:
            q, _ = np.linalg.qr(np.vstack((np.sqrt(c) * x, eye)))
            new = (v / c) * x + (w - v / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        else:
            z = np.linalg.cholesky(eye + c * (x.T @ x))
            half = np.linalg.solve(z, x.T)
            new = (v / c) * x + (w - v / c) * np.linalg.solve(z.T, half).T
        new = (new + new.T) / 2
        low = min(low * (w + v * l2) / (1 + c * l2), 1.0)
        moved, x = np.linalg.norm(new - x), new
        if moved <= 10 * n * EPS and 1 - low < 1e-12:
            break
    return x


def _split(a: np.ndarray, floor: float, rng: np.random.Generator) -> np.ndarray:
    """Orthonormal eigenvectors of symmetric ``a`` as columns."""
    n = len(a)
    middle = np.trace(a) / n
    if n == 1 or np.linalg.norm(a - middle * np.eye(n)) <= floor:
        return np.eye(n)
    spread = np.linalg.norm(a - middle * np.eye(n)) / np.sqrt(n)
    # The mean eigenvalue always parts them; the median of the diagonal does so more evenly.
    for shift in (np.median(np.diag(a)), middle, middle + 0.01 * spread, middle - 0.01 * spread):
        sign = polar_factor(a - shift * np.eye(n))
        k = int(round((np.trace(sign) + n) / 2))
        if not 0 < k < n or np.linalg.norm(sign @ sign - np.eye(n)) > 1e-8:
            continue
        projector = (sign + np.eye(n)) / 2
        q, _ = np.linalg.qr(np.hstack((projector @ rng.standard_normal((n, k)), (np.eye(n) - projector) @ rng.standard_normal((n, n - k)))))
        for _ in range(2):
            q, _ = np.linalg.qr(np.hstack((projector @ q[:, :k], q[:, k:] - projector @ q[:, k:])))
        turned = q.T @ a @ q
        if np.linalg.norm(turned[:k, k:]) <= 1e-12 * np.linalg.norm(a) + floor:
            upper = _split((turned[:k, :k] + turned[:k, :k].T) / 2, floor, rng)
            lower = _split((turned[k:, k:] + turned[k:, k:].T) / 2, floor, rng)
            return np.hstack((q[:, :k] @ upper, q[:, k:] @ lower))
    raise ArithmeticError("no shift parts the spectrum")


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix by divide and conquer."""
    a = (a + a.T) / 2
    n = len(a)
    vectors = _split(a, 4 * EPS * np.linalg.norm(a), np.random.default_rng(7)) if n else np.zeros((0, 0))
    vectors = vectors @ (1.5 * np.eye(n) - 0.5 * (vectors.T @ vectors))  # one Newton step back to orthonormal
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    if n:
        largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(n)]
        vectors = vectors * np.where(largest < 0, -1.0, 1.0)
    return values, vectors


@dataclass
class Whitening:
    n: int  # distinct vectors
    sums: list[int]  # per dimension
    explained: np.ndarray
    axes: np.ndarray  # dimensions x components, each over the root of its eigenvalue (0: no variance)

    @property
    def floors(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rests(self) -> list[int]:
        """sums less n times the rounded-down mean, in [0, n)."""
        return [s % self.n for s in self.sums]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([r / self.n for r in self.rests])
        return ((x - self.floors).astype(np.float64) - mean) @ self.axes

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum of (n * x - sums)^2 of each row, exact."""
        y, rest = x - self.floors, self.rests
        largest = int(np.abs(y).max(initial=0)) + 1
        if len(self.sums) * (self.n * largest) ** 2 < 1 << 62:
            return pa.array(((self.n * y - np.array(rest, np.int64)) ** 2).sum(axis=1)).cast(pa.decimal128(38, 0))
        y = y.astype(object)
        total = ((self.n * y - np.array(rest, object)) ** 2).sum(axis=1)
        return pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): the usable vectors as integers, all of one length."""
    clean = embeddings.select("vec_id", "embedding").where(V.is_finite(F.col("embedding")) & (F.size("embedding") > 0))
    lengths = clean.groupBy(F.size("embedding").alias("dims")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
    return clean.where(F.size("embedding") == (most["dims"] if most else 0)).select("vec_id", V.scaled(F.col("embedding"), SCALE, OFFSET).alias("x"))


def _summed(fit: DataFrame, cells: Callable[[np.ndarray], np.ndarray], exact: bool) -> dict[int, int | float]:
    """Adds up ``cells(x)``, a matrix of integers or doubles per batch, over the fit list: {cell: total}."""
    kind, arrow = ("decimal(38, 0)", pa.decimal128(38, 0)) if exact else ("double", pa.float64())

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = cells(V.matrix(batch["x"])).ravel()
                found = found.astype(object) if exact else found
                total = found if total is None else total + found
        if total is not None:
            values = [Decimal(int(t)) for t in total] if exact else total
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(values, arrow)], names=["cell", "total"])

    parts = fit.select("x").mapInArrow(partial, f"cell bigint, total {kind}")
    sums = parts.groupBy("cell").agg(F.sum("total").alias("total")).collect()  # dimensions squared at most
    return {r["cell"]: int(r["total"]) if exact else r["total"] for r in sums}


def _products(floors: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Exact sums of products of the centred integers, upper and lower half alike."""

    def cells(x: np.ndarray) -> np.ndarray:
        y = x - floors
        if len(y) * (int(np.abs(y).max()) + 1) ** 2 < 1 << 52:  # every partial sum is an exact double
            y = y.astype(np.float64)
            return (y.T @ y).astype(np.int64)
        y = y.astype(object)
        return y.T @ y

    return cells


def fit_whitening(fit: DataFrame, components: int = N_COMPONENTS) -> Whitening | None:
    """Fits on the rows (x) of ``fit``, each distinct vector once; None without rows."""
    first = _summed(fit, lambda x: np.concatenate(([len(x)], x.sum(axis=0))), exact=True)
    if not first:
        return None
    n, sums = first[0], [first[k] for k in range(1, len(first))]
    d = len(sums)
    whitening = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)))
    products, rest = _summed(fit, _products(whitening.floors), exact=True), whitening.rests
    exact = [[n * products[i * d + j] - rest[i] * rest[j] for j in range(d)] for i in range(d)]
    covariance = np.array([[v / (n * n) for v in row] for row in exact])
    trace = sum(exact[i][i] for i in range(d)) / (n * n)
    values, axes = eigen(covariance)
    values, axes = values[:components], axes[:, :components]
    varies = values > d * EPS * trace
    whitening.explained = np.where(varies, values, 0.0) / trace if trace else np.zeros(len(values))
    whitening.axes = np.where(varies, axes / np.sqrt(np.where(varies, values, 1.0)), 0.0)
    return whitening


def identity_error(fit: DataFrame, whitening: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity."""
    k = whitening.axes.shape[1]

    def cells(x: np.ndarray) -> np.ndarray:
        w = whitening.whiten(x)
        w = np.hstack((np.ones((len(w), 1)), w))
        return w.T @ w

    total = _summed(fit, cells, exact=False)
    m = np.array([total[c] for c in range((k + 1) ** 2)]).reshape(k + 1, k + 1) / whitening.n
    varies = np.flatnonzero(whitening.explained > 0)
    covariance = (m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]))[np.ix_(varies, varies)]
    return float(np.abs(covariance - np.eye(len(varies))).max(initial=0.0))


def whiten(vectors: DataFrame, whitening: Whitening) -> DataFrame:
    """``vectors`` with ``deviation`` (decimal) and ``whitened`` (one double per component)."""

    @F.arrow_udf("struct<deviation: decimal(38, 0), whitened: array<double>>")
    def turned(x: pa.Array) -> pa.Array:
        if not len(x):
            parts = [pa.array([], pa.decimal128(38, 0)), pa.array([], pa.list_(pa.float64()))]
        else:
            rows = V.matrix(x)
            parts = [whitening.deviations(rows), V.lists(whitening.whiten(rows))]
        return pa.StructArray.from_arrays(parts, ["deviation", "whitened"])

    return vectors.withColumn("__w", turned("x")).select(*vectors.columns, "__w.deviation", "__w.whitened")


def whiten_report(embeddings: DataFrame) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row and component."""
    vectors = materialized(usable_vectors(embeddings), "integers")
    fit = materialized(vectors.select("x").distinct(), "fit-list")
    whitening = fit_whitening(fit)
    if whitening is None:
        whitening, error = Whitening(0, [], np.zeros(0), np.zeros((0, 0))), 0.0
        rows = vectors.select("vec_id", F.lit(None).cast("decimal(38, 0)").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    else:
        error = identity_error(fit, whitening)
        rows = whiten(vectors, whitening).drop("x")
    explained = F.array(*[F.lit(float(e)) for e in whitening.explained]).cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(whitening.n).cast("bigint").alias("n"),
        F.col("deviation").cast("bigint").alias("deviation"),
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
