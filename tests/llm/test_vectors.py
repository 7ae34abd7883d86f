"""Whitening and clustering of vectors against exact arithmetic in plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyguard.llm import clustering, whitening

SCHEMA = "vec_id long, embedding array<float>, id string, vector int, cluster int"


def frame(spark, vectors, parts=3):
    rows = [(i, v, "x", 1, 2) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def random_vectors(n, dims, seed=1, spread=0.5):
    rnd = random.Random(seed)
    return [[float(np.float32(rnd.gauss(0, spread))) for _ in range(dims)] for _ in range(n)]


ODD = [None, [], [None] * 6, [math.nan] + [0.0] * 5, [math.inf] + [0.0] * 5, [1.0, 2.0]]


@pytest.mark.parametrize(
    "rows",
    [
        [[1, -2], [3, 4], [5, 0]],
        [[-(2**63), 2**63 - 2**21], [2**62, -5], [0, 0]],
        [[7, 7]],
        [[0] * 3] * 130,
        [[random.Random(i * 7 + j).randrange(-(2**40), 2**40) for j in range(3)] for i in range(200)],
    ],
)
def test_moments_are_exact(rows):
    found = np.array(rows, np.int64)
    moments = whitening.Moments(found.shape[1])
    moments.add(found)
    moments.add(found[:1])
    exact = np.array([*rows, rows[0]], object)
    assert moments.n == len(exact) and (moments.sums == exact.sum(axis=0)).all()
    assert (moments.products == exact.T @ exact).all()


def whitened_by_hand(vectors):
    """n, exact deviations, covariance of the whole numbers and their centred values."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    apart = n * x - sums
    return n, (apart * apart).sum(axis=1).tolist(), (apart.T @ apart / n**3).astype(float), (apart / n).astype(float)


def test_whitening(spark):
    vectors = random_vectors(700, 40)
    vectors += [vectors[0]] * 300  # copies
    rows = whitening.components(frame(spark, vectors + ODD)).collect()
    n, deviation, covariance, centred = whitened_by_hand(vectors)
    values = np.linalg.eigvalsh(covariance)[::-1]
    assert {(r.vec_id, r.component) for r in rows} == {(i, k) for i in range(n) for k in range(1, 33)} and len(rows) == 32 * n
    white = np.zeros((n, 32))
    for r in rows:
        white[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviation[r.vec_id] and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
    assert np.abs(white.T @ white / n - np.eye(32)).max() < 1e-9
    # Each column is the projection on an eigenvector: covariance with the input is the eigenvector times sqrt(e).
    directions = centred.T @ white / n / np.sqrt(values[:32])
    assert np.abs(covariance @ directions - directions * values[:32]).max() < 1e-9


def test_whitening_of_few_constant_and_huge_values(spark):
    assert whitening.components(frame(spark, [])).isEmpty() and whitening.components(frame(spark, ODD[:2])).isEmpty()
    assert whitening.components(frame(spark, [[1.0, 2.0]])).isEmpty()
    assert whitening.components(frame(spark, [[1.0, 2.0]] * 5)).isEmpty()
    rows = whitening.components(frame(spark, [[0.0, 5.0], [1.0, 5.0], [1.0, 5.0], [2.0, 5.0]])).collect()
    assert [r.component for r in rows] == [1] * 4 and {r.explained for r in rows} == {1.0}
    assert sorted(abs(round(r.whitened, 6)) for r in rows) == [0.0, 0.0, round(2**0.5, 6), round(2**0.5, 6)]
    huge = [[1e30, 0.0], [-1e30, 0.5], [0.0, 1.0]]
    rows = whitening.components(frame(spark, huge)).collect()
    assert {r.deviation for r in rows if r.vec_id < 2} == {None} and all(math.isfinite(r.whitened) for r in rows)


def test_whitening_is_the_same_under_any_partitioning(spark):
    vectors = random_vectors(300, 8)
    few, many = (whitening.components(frame(spark, vectors, k)).orderBy("vec_id", "component").collect() for k in (1, 7))
    assert [r[:6] for r in few] == [r[:6] for r in many]


def clusters_by_hand(vectors, dims, k=8, rounds=10):
    good = {
        i: [math.floor(1024 * c) for c in v]
        for i, v in enumerate(vectors)
        if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)
    }
    start = sorted(good, key=lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest())[:k]
    centroids = [good[i] for i in start]

    def assigned():
        return {
            i: min((sum((a - b) ** 2 for a, b in zip(v, c)), at) for at, c in enumerate(centroids)) for i, v in good.items()
        }

    for _ in range(rounds):
        found = assigned()
        for at in range(len(centroids)):
            mine = [good[i] for i, (_, c) in found.items() if c == at]
            if mine:
                centroids[at] = [sum(column) // len(mine) for column in zip(*mine)]
    return assigned(), centroids


@pytest.mark.parametrize("kind", ["scattered", "copies", "few", "huge"])
def test_clusters(spark, kind):
    vectors = random_vectors(400, 6, spread=0.2)
    if kind == "copies":
        vectors = vectors[:60] + [vectors[0]] * 200 + [vectors[1]] * 5
    if kind == "few":
        vectors = vectors[:5] + [vectors[0]]
    if kind == "huge":
        vectors = vectors[:50] + [[1e6 * i, -3e5, 0.0, 1.0, 2.0, 3.0] for i in range(20)]
    rows, centroids, inertia = clustering.clusters(frame(spark, vectors + ODD), dims=6)
    want, want_centroids = clusters_by_hand(vectors + ODD, 6)
    assert {r.vec_id: (r.distance, r.cluster) for r in rows.collect()} == want
    assert centroids == want_centroids
    assert inertia == [sum(d for d, c in want.values() if c == at) for at in range(len(centroids))]


def test_clusters_of_nothing_and_beyond_a_long(spark):
    rows, centroids, _ = clustering.clusters(frame(spark, ODD), dims=6)
    assert rows.isEmpty() and rows.columns == ["vec_id", "cluster", "distance"] and centroids == []
    far = [[3e38, 0.0], [-3e38, 0.0], [2.9e38, 0.0]]
    rows, _, _ = clustering.clusters(frame(spark, far), dims=2, k=1, rounds=1)
    assert {r.distance for r in rows.collect()} == {None}


def test_dictionaries_lose_nothing():
    rng = np.random.default_rng(3)
    scattered, copies = rng.integers(-20, 20, (900, 10)).astype(float), np.repeat(rng.integers(-9, 9, (3, 10)).astype(float), 300, axis=0)
    for found in (scattered, copies, scattered[:1]):
        words, codes = clustering.encode(found)
        assert (np.hstack([w[c] for w, c in zip(words, codes)]) == found).all()
        assert all(len(np.unique(w, axis=0)) == len(w) for w in words)
    assert max(w.shape[1] for w in clustering.encode(copies)[0]) == 8
    assert {w.shape[1] for w in clustering.encode(scattered)[0]} == {1}


def test_queries_over_a_table(spark, tmp_path):
    vectors = random_vectors(120, 64) + [None, [1.0] * 63, [math.nan] * 64]
    rows = [(i, v, 0) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    white = whitening.query(spark, str(tmp_path))
    assert white.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert white.count() == 120 * 32 and white.agg(F.max("identity_error")).first()[0] < 1e-4
    found = clustering.query(spark, str(tmp_path))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    want, centroids = clusters_by_hand(vectors, 64)
    for r in found.collect():
        assert (r.distance, r.cluster) == want[r.vec_id] and r.inertia == sum(d for d, _ in want.values())
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()
