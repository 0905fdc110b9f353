"""Clustering against plain loops over exact integers, and the bounds."""

import hashlib
import math
import random
from itertools import pairwise

import numpy as np
import pytest

from hemeroteca.llm import centroids, queries


def plain(rows, k=16, rounds=3, size=64, scale=64):
    """rows: (id, components). Returns {(id, vector): (cluster, distance, ...)} as a list in the order of the kept rows."""
    kept = [
        (i, tuple(math.floor(scale * x) for x in v))
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted((r for r in kept if r[0] is not None), key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    order += sorted((r for r in kept if r[0] is None), key=lambda r: r[1])
    centres = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for n in range(len(centres)):
            own = [v for (_, v), f in zip(kept, found, strict=True) if f == n]
            if own:
                centres[n] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    last = [nearest(v) for _, v in kept]
    total = sum(d for d, _ in last)
    inertia = [sum(d for d, f in last if f == n) for n in range(len(centres))]
    return [(i, n, d, inertia[n], total, centres[n]) for (i, _), (d, n) in zip(kept, last, strict=True)]


def as_rows(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in df.collect()), key=str)


@pytest.mark.parametrize(("k", "rounds", "size", "spread"), [(16, 3, 8, 1.0), (5, 2, 3, 0.05), (16, 3, 2, 100.0)])
def test_equals_plain_loops(spark, k, rounds, size, spread):
    rnd = random.Random(size)
    rows = [(i, [rnd.gauss(i % 4 * spread, spread) for _ in range(size)]) for i in range(400)]
    rows += [(i % 7, rows[i % 50][1]) for i in range(60)]  # repeated ids and vectors
    rows += [(900, None), (901, []), (902, [1.0] * (size + 1)), (903, [None] * size), (904, [math.nan] * size), (905, [math.inf] * size)]
    rows += [(None, [0.5] * size), (906, [-0.0] * size)]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "vec_id long, embedding array<double>, V string, cluster int").repartition(5)
    assert as_rows(centroids.cluster(df, k, rounds, size)) == sorted(plain(rows, k, rounds, size), key=str)


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [5.0, 5.0])], "vec_id int, embedding array<float>")
    assert as_rows(centroids.cluster(df, 16, 3, 2)) == sorted(plain([tuple(r) for r in df.collect()], 16, 3, 2), key=str)
    none = centroids.cluster(df.limit(0), 16, 3, 2)
    assert none.collect() == [] and none.columns == centroids.cluster(df, 16, 3, 2).columns
    far = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-(2.0**21), 0.0])], "vec_id int, embedding array<double>")
    assert [r.vec_id for r in centroids.cluster(far, 2, 1, 2).collect()] == [2]


def test_bounds_hold_and_spare_work():
    rnd = np.random.default_rng(5)
    for scale in (3, 1 << 20):
        groups = rnd.integers(-60, 60, (16, 64)) * scale
        vectors = groups[rnd.integers(0, 16, 3000)] + rnd.integers(-3, 4, (3000, 64)) * scale
        pivots = centroids.choose_pivots(vectors[:200], 6)
        nearest = centroids.Nearest(groups, pivots)
        exact, to_pivots = centroids.squared(vectors, groups), centroids.squared(vectors, pivots)
        assert (nearest.bounds(to_pivots) <= exact * (1 + centroids.SLACK)).all()
        number, distance, measured = nearest.assign(vectors, to_pivots)
        assert (number == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
        assert measured < 0.5 * exact.size
    alike = np.zeros((10, 4), np.int64)
    assert len(centroids.choose_pivots(alike, 6)) == 1
    number, _, _ = centroids.Nearest(alike, alike[:1]).assign(alike, centroids.squared(alike, alike[:1]))
    assert (number == 0).all()


def test_pivots_are_far_apart():
    pool = np.array([[0, 0], [1, 0], [10, 0], [0, 9], [1, 1]])
    assert centroids.choose_pivots(pool, 3).tolist() == [[0, 0], [10, 0], [0, 9]]
    assert all(a != b for a, b in pairwise(centroids.choose_pivots(pool, 5).tolist()))


def test_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = sorted((i, n, d, c, t, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for i, n, d, c, t, v in plain(rows))
    got = queries.op12_centroids(spark, sf)
    assert sorted(map(tuple, got.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())) == want
