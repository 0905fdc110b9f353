"""Centroid clustering with Ptolemaic bounds over fixed pivots.

For any four points, d(x,c) d(p,q) >= |d(x,p) d(q,c) - d(x,q) d(p,c)|. With distances to a few fixed pivots stored
beside each vector, and those of the centroids worked out once a round, every pair of pivots bounds the distance of a
vector to a centroid from below. The centroid of the lowest bound is measured first; only those whose bound isn't
above that distance are measured too. Vectors and centroids are integers, so measured distances are exact; bounds are
floats and give way by more than their rounding error.

Rounds read one stored table and pass back sums: as many rows a task as there are centroids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemeroteca.llm.batches import tidied
from hemeroteca.sources.writers import materialise

#: Vectors with a component beyond this, once whole numbers, are left out: their squared distances pass 64 bits.
FARTHEST = 1 << 27
#: Pivots, and of how many of the first vectors by hash they are the ones farthest apart.
PIVOTS, POOL = 6, 256
#: Distances between vectors and centroids that are measured at once.
AT_ONCE = 1 << 15
#: Share of a bound that floats may be off by, with room to spare: an operation is off by 2 to the -53.
SLACK = 1e-13


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``a`` to the rows of ``b``, exact."""
    return np.stack([np.square(a - row).sum(axis=1) for row in b], axis=1) if len(b) else np.zeros((len(a), 0), np.int64)


def choose_pivots(pool: np.ndarray, count: int) -> np.ndarray:
    """The first vector, then again and again the one farthest from all chosen ones; fewer if they are all alike."""
    chosen, nearest = [0], squared(pool, pool[:1])[:, 0]
    while len(chosen) < count and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(pool, pool[chosen[-1:]])[:, 0])
    return pool[chosen]


@dataclass
class Nearest:
    """The nearest centroid of any vector, the first of several."""

    centroids: np.ndarray
    pivots: np.ndarray

    def bounds(self, to_pivots: np.ndarray) -> np.ndarray:
        """A lower bound of the squared distance to each centroid, from the squared distances to the pivots."""
        own, theirs = np.sqrt(to_pivots.astype(np.float64)), np.sqrt(squared(self.centroids, self.pivots).astype(np.float64))
        between = np.sqrt(squared(self.pivots, self.pivots).astype(np.float64))
        best = np.zeros((len(own), len(self.centroids)))
        for p, q in combinations(range(len(self.pivots)), 2):
            one, other = np.outer(own[:, p], theirs[:, q]), np.outer(own[:, q], theirs[:, p])
            np.maximum(best, (np.abs(one - other) - SLACK * (one + other)) / between[p, q], out=best)
        return np.square(best) * (1 - SLACK)

    def assign(self, vectors: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number of the nearest centroid, squared distance to it, how many distances were measured)."""
        bound = self.bounds(to_pivots)
        rows = np.arange(len(vectors))
        first = bound.argmin(axis=1)
        found = np.square(vectors - self.centroids[first]).sum(axis=1)
        # Floats above 2 to the 53 are off by less than the slack.
        maybe = bound <= (found * (1 + SLACK))[:, None]
        maybe[rows, first] = False
        row, centroid = np.nonzero(maybe)
        all_found = np.full((len(vectors), len(self.centroids)), np.iinfo(np.int64).max)
        all_found[rows, first] = found
        for at in range(0, len(row), AT_ONCE):
            r, c = row[at : at + AT_ONCE], centroid[at : at + AT_ONCE]
            all_found[r, c] = np.square(vectors[r] - self.centroids[c]).sum(axis=1)
        nearest = all_found.argmin(axis=1)
        return nearest, all_found[rows, nearest], len(vectors) + len(row)


def whole_vectors(vectors: DataFrame, size: int, scale: int, key: str, vector: str) -> DataFrame:
    """(``id``, ``v``) of the vectors of ``size`` finite components, as whole numbers floor(scale * x)."""
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= FARTHEST / scale))
    return rows.where((F.size("v") == size) & fine).withColumn("v", F.transform("v", lambda x: F.floor(scale * x)))


def _flat(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, size)


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Assign every kept vector to a centroid: the key, ``cluster``, ``distance`` (squared), ``cluster_inertia`` and
    ``inertia`` (its sums over the cluster and over all), ``centroid`` (the final one).

    Kept are vectors of exactly ``size`` components, none null, not finite, or beyond ``FARTHEST`` once scaled; each
    component becomes floor(scale * x). Centroids start as the ``k`` kept vectors of smallest sha256 of "1:key"; rows
    that tie in it go by their components, a null key comes last. Fewer vectors make fewer centroids. Each round
    assigns all vectors, ties to the lower number, and moves every centroid to the componentwise floor of its
    vectors' mean; one without vectors stays. Repeated rows count each. Other columns are left out. An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, size, scale, key, vector)
    order = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256).asc_nulls_last()
    pool = np.array([r["v"] for r in whole.orderBy(order, "v").limit(max(k, POOL)).collect()], np.int64).reshape(-1, size)
    kind = whole.schema["id"]
    if not len(pool):
        return spark.createDataFrame([], T.StructType([T.StructField(key, kind.dataType), *T.StructType.fromDDL(_RESULT).fields]))
    centroids, pivots = pool[:k].copy(), choose_pivots(pool[:POOL], PIVOTS)

    def with_distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = squared(_flat(batch.column(1), size), pivots)
            lists = pa.ListArray.from_arrays(np.arange(len(own) + 1, dtype=np.int32) * len(pivots), own.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["id", "v", "to_pivots"])

    schema = T.StructType([kind, *T.StructType.fromDDL("v array<long>, to_pivots array<long>").fields])
    stored = materialise(whole.mapInArrow(tidied(with_distances), schema), "vectors")
    for _ in range(rounds):
        for row in _sums(stored, Nearest(centroids, pivots), size).collect():  # a row a centroid
            centroids[row["cluster"]] = [s // row["n"] for s in row["sums"]]
    placed = materialise(_assigned(stored, Nearest(centroids, pivots), size), "placed")
    sums = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    facts = [(c, s, sum(sums.values()), centroids[c].tolist()) for c, s in sums.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    found = placed.join(F.broadcast(facts), "cluster")  # at most k rows
    return found.select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


_RESULT = "cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"


def _assigned(stored: DataFrame, nearest: Nearest, size: int) -> DataFrame:
    """(id, cluster, distance) of every stored vector."""

    def run(batches):
        for batch in batches:
            number, distance, _ = nearest.assign(_flat(batch.column(1), size), _flat(batch.column(2), len(nearest.pivots)))
            columns = [batch.column(0), pa.array(number.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "cluster", "distance"])

    schema = T.StructType([stored.schema["id"], *T.StructType.fromDDL("cluster int, distance long").fields])
    return stored.mapInArrow(tidied(run), schema)


def _sums(stored: DataFrame, nearest: Nearest, size: int) -> DataFrame:
    """(cluster, n, sums) over all vectors, added up in each task first."""

    def run(batches):
        k = len(nearest.centroids)
        n, sums = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            vectors = _flat(batch.column(1), size)
            number = nearest.assign(vectors, _flat(batch.column(2), len(nearest.pivots)))[0]
            n += np.bincount(number, minlength=k)
            np.add.at(sums, number, vectors)
        some = np.flatnonzero(n)
        lists = pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * size, sums[some].ravel())
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), lists], names=["cluster", "n", "sums"])

    parts = stored.mapInArrow(tidied(run), "cluster int, n long, sums array<long>")
    added = [F.sum(F.get("sums", F.lit(i))) for i in range(size)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*added).alias("sums"))
