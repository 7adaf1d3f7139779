"""Centroid clustering (Lloyd's rounds) over integer vectors with a LAESA pivot table.

A few fixed pivots are drawn once, and every vector's distances to them are
stored beside it. In each round the centroids' distances to the same pivots
are computed on the driver (a matrix of k rows), and by the triangle
inequality ``max |d(x, p) - d(c, p)|`` bounds the distance of vector and
centroid from below. A vector meets its centroids in the order of their
bounds; those whose bound exceeds the best distance so far are left out, the
surviving ones get exact integer distances. Bounds only save work: the
assignment is that of comparing all.

A round is one scan of the stored table; a partition sends one sum per
centroid and component. The pivots are chosen far apart among the
``PIVOT_SAMPLE`` vectors with the lowest hashes (a bounded sample: the choice
decides how much is pruned, never the result).

Defined cases:

* vectors that are null, of another length or hold null or non-finite entries
  are dropped; entries need |scale * x| < 2^27 (else an error), so squared
  distances are exact longs;
* ties in distance go to the smaller centroid number; rows that repeat a
  vector are assigned alike; rows that repeat an id are rows of their own;
* null id: hashed after all others; fewer vectors than centroids: as many
  centroids as vectors; empty table: no rows; a centroid without vectors stays;
* extra columns are not read, whatever their names; there are no texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import vectors as V
from marquee.session import materialized

DIMS = 64
SCALE = 1024
N_CENTROIDS = 8
ROUNDS = 10
N_PIVOTS = 12
PIVOT_SAMPLE = 1024
LARGEST = 1 << 27
SEED = "3:"


def kept_vectors(embeddings: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): the usable vectors as integers."""
    usable = embeddings.select("vec_id", "embedding").where((F.size("embedding") == dims) & V.is_finite(F.col("embedding")))
    return usable.select("vec_id", V.scaled(F.col("embedding"), scale).alias("x"))


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``x`` to all of ``points``, as doubles."""
    return np.sqrt(np.stack([((x - p) ** 2).sum(axis=1) for p in points], axis=1).astype(np.float64))


def far_apart(sample: np.ndarray, n_pivots: int) -> np.ndarray:
    """Pivots out of ``sample``: each next one has the largest distance sum to those before (ties: the first)."""
    chosen = [0] if len(sample) else []
    total = np.zeros(len(sample))
    while chosen and len(chosen) < min(n_pivots, len(sample)):
        total += _distances(sample, sample[chosen[-1:]])[:, 0]
        total[chosen] = -np.inf
        chosen.append(int(np.argmax(total)))
    return sample[chosen]


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vectors`` with the stored distances to the pivots."""

    @F.arrow_udf("array<double>")
    def to_pivots(x: pa.Array) -> pa.Array:
        rows = V.matrix(x)
        if len(rows) and np.abs(rows).max() >= LARGEST:
            raise ValueError("a component is too large for exact distances")
        return V.lists(_distances(rows, pivots)) if len(rows) else pa.array([], pa.list_(pa.float64()))

    return vectors.withColumn("to_pivots", to_pivots("x"))


def nearest(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centroid, squared distance, number of exact distances) of each row."""
    of_centroids = _distances(centroids, pivots)
    n, k = len(x), len(centroids)
    bound = np.zeros((n, k))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - of_centroids[None, :, p]), out=bound)
    # Square roots are off by less than this, so a bound never exceeds the true distance.
    slack = 1e-12 * (to_pivots.max(axis=1, initial=0.0) + of_centroids.max(initial=0.0)) + 1e-9
    bound = np.maximum(bound - slack[:, None], 0.0) ** 2 * (1 - 1e-12)
    order = np.argsort(bound, axis=1, kind="stable")
    best, label, exact = np.full(n, np.iinfo(np.int64).max), np.full(n, k), np.zeros(n, np.int64)
    for place in range(k):
        candidate = order[:, place]
        rows = np.flatnonzero(bound[np.arange(n), candidate] <= best)
        if not len(rows):
            break
        of = candidate[rows]
        distance = ((x[rows] - centroids[of]) ** 2).sum(axis=1)
        exact[rows] += 1
        better = (distance < best[rows]) | ((distance == best[rows]) & (of < label[rows]))
        best[rows[better]], label[rows[better]] = distance[better], of[better]
    return label, best, exact


def _sums(centroids: np.ndarray, pivots: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per partition: (cluster, component, sum, count) of the vectors assigned to each centroid."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centroids.shape
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = V.matrix(batch["x"])
            label, _, _ = nearest(x, V.matrix(batch["to_pivots"], np.float64), centroids, pivots)
            for c in range(k):
                total[c] += x[label == c].sum(axis=0)
            count += np.bincount(label, minlength=k)
        cells = np.indices((k, dims))
        yield pa.RecordBatch.from_arrays(
            [pa.array(a.ravel()) for a in (cells[0], cells[1], total, np.repeat(count, dims))], names=["cluster", "component", "total", "n"]
        )

    return partial


def _next_centroids(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    cells = table.select("x", "to_pivots").mapInArrow(_sums(centroids, pivots), "cluster bigint, component bigint, total bigint, n bigint")
    sums = cells.groupBy("cluster", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for r in sums.where("n > 0").collect():  # k x dims rows
        moved[r["cluster"], r["component"]] = r["total"] // r["n"]
    return moved


def fit(vectors: DataFrame, k: int = N_CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(stored table with pivot distances, final centroids, pivots) of (vec_id, x) rows."""
    digest = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    lowest = vectors.orderBy(digest.asc_nulls_last(), "x").limit(max(PIVOT_SAMPLE, k)).toArrow()
    sample = V.matrix(lowest["x"]) if lowest.num_rows else np.zeros((0, 0), np.int64)
    pivots, centroids = far_apart(sample[:PIVOT_SAMPLE], N_PIVOTS), sample[:k].copy()
    table = materialized(pivot_table(vectors, pivots), "pivot-table")
    for _ in range(rounds if len(centroids) else 0):
        centroids = _next_centroids(table, centroids, pivots)
    return table, centroids, pivots


def assign(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance, n_exact): nearest centroid, squared distance and exact distances computed."""

    @F.arrow_udf("struct<cluster: int, distance: bigint, n_exact: bigint>")
    def place(x: pa.Array, to_pivots: pa.Array) -> pa.Array:
        names = ["cluster", "distance", "n_exact"]
        if not len(x):
            return pa.StructArray.from_arrays([pa.array([], pa.int32()), pa.array([], pa.int64()), pa.array([], pa.int64())], names)
        label, best, exact = nearest(V.matrix(x), V.matrix(to_pivots, np.float64), centroids, pivots)
        return pa.StructArray.from_arrays([pa.array(label.astype(np.int32)), pa.array(best), pa.array(exact)], names)

    return table.select("vec_id", place("x", "to_pivots").alias("__c")).select("vec_id", "__c.*")


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()


def cluster_report(embeddings: DataFrame) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    spark = embeddings.sparkSession
    table, centroids, pivots = fit(kept_vectors(embeddings))
    placed = materialized(assign(table, centroids, pivots), "assigned")
    of_cluster = {r["cluster"]: r["d"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    of_all = sum(of_cluster.values())
    clusters = [(c, of_cluster.get(c, 0), of_all, centroid_digest(v)) for c, v in enumerate(centroids)]
    schema = "c int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    named = spark.createDataFrame(clusters, schema)  # k rows
    return placed.join(F.broadcast(named), F.col("cluster") == F.col("c")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
