"""Centroid clustering against plain integer arithmetic."""

import hashlib
import math
import random

import numpy as np
import pytest

from ledgerweave.llm import pivots

DIMS = 64


def plainly(rows, k=16, rounds=3, seed=1):
    kept = []
    for key, values in rows:
        if values is None or len(values) != DIMS or any(x is None or not math.isfinite(x) for x in values):
            continue
        v = tuple(max(min(math.floor(64 * x), pivots.MOST), -pivots.MOST) for x in values)
        kept.append((hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest(), v, key))
    kept.sort(key=lambda row: row[:2])
    centroids = [v for _, v, _ in kept[:k]]

    def assign():
        told = []
        for _, v, key in kept:
            told.append((*min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)), v, key))
        return told

    for _ in range(rounds):
        told = assign()
        for j in range(len(centroids)):
            own = [v for _, at, v, _ in told if at == j]
            if own:
                centroids[j] = tuple(sum(x) // len(own) for x in zip(*own))
    return sorted(((-1 if key is None else key), j, d) for d, j, _, key in assign()), centroids


def some_vectors(n, seed=1, spread=1.0):
    chance = random.Random(seed)
    middles = [[chance.gauss(0, spread) for _ in range(DIMS)] for _ in range(9)]
    return [(i, [float(np.float32(x + chance.gauss(0, spread / 3))) for x in chance.choice(middles)]) for i in range(n)]


def odd_vectors():
    rows = some_vectors(40)
    whole = rows[0][1]
    rows += [(100, None), (101, whole[:-1]), (102, [*whole, 1.0]), (103, [None, *whole[1:]])]
    rows += [(104, [float("nan"), *whole[1:]]), (105, [float("inf"), *whole[1:]]), (106, [-float("inf"), *whole[1:]])]
    rows += [(107, [-0.001] * DIMS), (108, [3e38] * DIMS), (109, [-3e38] * DIMS), (3, whole), (3, whole), (None, whole), (None, rows[5][1])]
    return rows


@pytest.mark.parametrize("rows", [some_vectors(300), some_vectors(200, 2, 0.02), odd_vectors(), some_vectors(5), [(i, [0.5] * DIMS) for i in range(40)]])
def test_equals_plain_arithmetic(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found = pivots.cluster(frame)
    want, centroids = plainly(rows)
    got = sorted(((-1 if r.key is None else r.key), r.cluster, r.distance) for r in found.assigned.collect())
    assert got == want
    assert [tuple(c) for c in found.centroids.tolist()] == centroids
    inertia = sum(d for *_, d in want)
    for row in pivots.with_inertia(found).collect():
        assert row.inertia == min(inertia, pivots.LONGEST)
        assert row.cluster_inertia == min(sum(d for _, j, d in want if j == row.cluster), pivots.LONGEST)
        told = ",".join(map(str, centroids[row.cluster]))
        assert row.centroid_sha256 == hashlib.sha256(told.encode()).hexdigest()


def test_bounds_save_distances_and_lose_none():
    chance = np.random.default_rng(4)
    middles = chance.integers(-300, 300, (16, DIMS))
    v = np.concatenate([m + chance.integers(-20, 20, (50, DIMS)) for m in middles]).astype(np.int64)
    points = middles[:8].astype(np.int64)
    d = np.stack([((v - p) ** 2).sum(axis=1) for p in points], axis=1)
    cluster, best, measured = pivots.nearest(v, d, middles, points)
    every = ((v[:, None] - middles[None]) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert measured < 0.3 * every.size


def test_empty_table_and_extra_columns(spark):
    schema = "vec_id long, embedding array<float>, cluster string, v int, key int, distance string"
    none = spark.createDataFrame([], schema)
    assert pivots.with_inertia(pivots.cluster(none)).count() == 0
    rows = [(*r, "x", 1, 2, "y") for r in some_vectors(20)]
    found = pivots.cluster(spark.createDataFrame(rows, schema))
    assert found.assigned.columns == ["key", "cluster", "distance"] and found.assigned.count() == 20
