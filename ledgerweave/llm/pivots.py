"""Centroid clustering over a pivot table (LAESA).

Vectors become integers, so that every distance and every centroid is exact. The distances
of all vectors to a few fixed pivots are worked out and stored once. In each round a
centroid's distances to the pivots are compared with a vector's: by the triangle inequality
the largest difference is a lower bound of their distance. The centroid with the least
bound is measured first, the others only where their bound does not exceed what is best.

A round is one pass over the stored table; every task reduces its rows to one sum for each
cluster and component ahead of the shuffle, so neither a hot cluster nor a hot vector matters.
What reaches the driver is the sums, ``k`` x dimensions numbers, and the first centroids.

Nulls and odd input: vectors that are null, of another length, or with a null or non-finite
component are left out. Rows with equal keys are vectors of their own; a null key is hashed as
an empty one, ties among the first centroids go by the components. With fewer than ``k``
vectors each of them is a centroid; none gives no rows. Integer components are held within
±2^27, which keeps every squared distance of up to 64 of them a long; sums beyond a long
read as the greatest long. Other columns of the input play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, materialise

DIMENSIONS = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
PIVOTS = 8  # distances stored for each vector
MOST = 1 << 27
LONGEST = (1 << 63) - 1
BATCH = 2048  # vectors measured at once


class Clustering(NamedTuple):
    """``key, cluster, distance`` of every vector, and the final centroids."""

    assigned: DataFrame
    centroids: np.ndarray


def integer_vectors(vectors: DataFrame, key: str, values: str, dims: int = DIMENSIONS) -> DataFrame:
    """``key`` and integer components ``v`` of the vectors that can be clustered."""
    x = F.col(values).cast("array<double>")
    fit = F.size(x) == dims
    for odd in (lambda c: c.isNull(), lambda c: F.isnan(c), lambda c: F.abs(c) == float("inf")):
        fit = fit & ~F.coalesce(F.exists(x, odd), F.lit(False))
    whole = F.transform(
        x, lambda c: F.greatest(F.least(F.floor(c * SCALE), F.lit(MOST)), F.lit(-MOST)).cast("int")
    )
    return vectors.filter(F.coalesce(fit, F.lit(False))).select(F.col(key).alias("key"), whole.alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose keys have the least hashes, in order of these."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(told, 256).alias("hash"), "v").orderBy("hash", "v").limit(k).collect()
    return np.array([row.v for row in rows], np.int64)


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _squares(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    apart = vectors - point
    return np.einsum("ij,ij->i", apart, apart)


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vectors`` with their exact squared distances ``d`` to the pivots."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                v = _matrix(column(batch, "v")).astype(np.int64)
                d = np.stack([_squares(v, p) for p in pivots], axis=1)
                ends = np.arange(0, d.size + 1, d.shape[1], dtype=np.int32)
                made = pa.ListArray.from_arrays(pa.array(ends), pa.array(d.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "key"), column(batch, "v"), made], names=["key", "v", "d"]
                )

    kind = vectors.schema["key"].dataType.simpleString()
    return vectors.mapInArrow(run, f"key {kind}, v array<int>, d array<bigint>")


def nearest(
    v: np.ndarray, d: np.ndarray, centroids: np.ndarray, pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid and squared distance of each vector, and how many were measured.

    Bounds are worked out in floating point and lowered by more than its error; distances
    that decide are integers. Of equally near centroids the first one counts.
    """
    n, k = len(v), len(centroids)
    apart = np.sqrt(d.astype(np.float64))
    bound = np.zeros((n, k))
    for j, centroid in enumerate(centroids):
        to_pivots = np.sqrt(_squares(pivots, centroid).astype(np.float64))
        error = 1e-12 * (apart.max(axis=1, initial=0.0) + to_pivots.max())
        bound[:, j] = np.abs(apart - to_pivots).max(axis=1) - error
    bound = np.maximum(bound, 0.0) ** 2 * (1 - 1e-12)
    cluster = bound.argmin(axis=1)
    best = np.empty(n, np.int64)
    for j in range(k):
        at = np.flatnonzero(cluster == j)
        best[at] = _squares(v[at], centroids[j])
    measured, began = n, cluster.copy()
    for j in range(k):
        at = np.flatnonzero((bound[:, j] <= best) & (began != j))
        found = _squares(v[at], centroids[j])
        closer = (found < best[at]) | ((found == best[at]) & (j < cluster[at]))
        best[at[closer]], cluster[at[closer]] = found[closer], j
        measured += len(at)
    return cluster, best, measured


def _assigned_batches(batches: Iterable[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray):
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH):
            batch = whole.slice(at, BATCH)
            v = _matrix(column(batch, "v")).astype(np.int64)
            d = _matrix(column(batch, "d"))
            yield batch, v, *nearest(v, d, centroids, pivots)[:2]


def _next_centroids(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: exact floors of the means of the vectors nearest to each centroid."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centroids.shape
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, v, cluster, _ in _assigned_batches(batches, centroids, pivots):
            counts += np.bincount(cluster, minlength=k)
            for j in np.unique(cluster):
                sums[j] += v[cluster == j].sum(axis=0)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(held, dims).astype(np.int32)),
                pa.array(np.tile(np.arange(dims, dtype=np.int32), len(held))),
                pa.array(sums[held].ravel()),
                pa.array(np.repeat(counts[held], dims)),
            ],
            names=["cluster", "component", "total", "n"],
        )

    parts = table.select("v", "d").mapInArrow(run, "cluster int, component int, total bigint, n bigint")
    sums = parts.groupBy("cluster", "component").agg(
        F.sum(F.col("total").cast("decimal(20,0)")).alias("total"), F.sum("n").alias("n")
    )
    moved = centroids.copy()
    for row in sums.collect():  # at most k x dimensions rows
        moved[row.cluster, row.component] = int(row.total) // row.n
    return moved


def cluster(
    vectors: DataFrame,
    key: str = "vec_id",
    values: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = 1,
    dims: int = DIMENSIONS,
    n_pivots: int = PIVOTS,
) -> Clustering:
    """Cluster ``vectors`` around ``k`` centroids; the pivots are the first of these."""
    whole = integer_vectors(vectors, key, values, dims)
    centroids = first_centroids(whole, k, seed)
    kind = whole.schema["key"].dataType.simpleString()
    schema = f"key {kind}, cluster int, distance bigint"
    if not len(centroids):
        return Clustering(vectors.sparkSession.createDataFrame([], schema), centroids)
    pivots = centroids[:n_pivots]
    table = materialise(pivot_table(whole, pivots))
    for _ in range(rounds):
        centroids = _next_centroids(table, centroids, pivots)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, nearest_to, distance in _assigned_batches(batches, centroids, pivots):
            yield pa.RecordBatch.from_arrays(
                [column(batch, "key"), pa.array(nearest_to.astype(np.int32)), pa.array(distance)],
                names=["key", "cluster", "distance"],
            )

    return Clustering(materialise(table.mapInArrow(run, schema)), centroids)


def with_inertia(found: Clustering) -> DataFrame:
    """The assignment with each cluster's and the whole inertia, and the centroids' digests."""
    total = F.sum(F.col("distance").cast("decimal(20,0)"))

    def held(value):
        return F.least(value, F.lit(LONGEST).cast("decimal(38,0)")).cast("long")

    per_cluster = found.assigned.groupBy("cluster").agg(total.alias("total")).collect()  # k rows
    whole = sum(int(row.total) for row in per_cluster)
    described = [
        (
            row.cluster,
            str(row.total),
            str(whole),
            hashlib.sha256(",".join(map(str, found.centroids[row.cluster])).encode()).hexdigest(),
        )
        for row in per_cluster
    ]
    clusters = found.assigned.sparkSession.createDataFrame(
        described, "cluster int, own string, whole string, centroid_sha256 string"
    )
    return found.assigned.join(F.broadcast(clusters), "cluster").select(
        "key",
        "cluster",
        "distance",
        held(F.col("own").cast("decimal(38,0)")).alias("cluster_inertia"),
        held(F.col("whole").cast("decimal(38,0)")).alias("inertia"),
        "centroid_sha256",
    )
