"""Centroid clustering of integer vectors by a bisector tournament.

For every pair of centroids i < j the plane between them is kept as an integer normal 2 (c_j - c_i) and a threshold
|c_j|^2 - |c_i|^2. A vector x is nearer to j exactly where x . normal exceeds the threshold; zero favours the smaller
number. k - 1 such tests, each against the winner so far, leave the nearest centroid; only its distance is computed.

Each round is one pass over the stored integer vectors; a task sends k partial sums. What reaches the driver is k sums of
``dim`` numbers a round. Sums are exact (decimals in Spark, whole numbers in Python), means are floors of exact quotients.

Defined results: vectors of another length, null, or with a null or non-finite component are not kept; integer components
beyond ``LIMIT`` raise an error, as distances would pass 64 bits (so does an inertia that does); equal hashes (repeated or null ids: null hashes last) start
in the order of their components; repeated rows are vectors of their own; fewer vectors than k give as many centroids; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

LIMIT = 1 << 27  # 64 squared differences of such components stay below 2^62


class Tournament:
    def __init__(self, centroids: list[list[int]]):
        c = np.array(centroids, np.int64)
        square = (c * c).sum(axis=1)
        self.centroids = c
        self.normals = 2 * (c[None, :, :] - c[:, None, :])  # [i, j]
        self.thresholds = square[None, :] - square[:, None]

    def winners(self, x: np.ndarray) -> np.ndarray:
        """Nearest centroid of every row; of equally near ones the smallest number."""
        best = np.zeros(len(x), np.int64)
        for j in range(1, len(self.centroids)):
            side = np.einsum("nd,nd->n", x, self.normals[best, j]) - self.thresholds[best, j]
            best = np.where(side > 0, j, best)
        return best

    def distances(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        apart = x - self.centroids[best]
        return np.einsum("nd,nd->n", apart, apart)


def integer_vectors(vectors: DataFrame, dim: int = 64, scale: int = 1024) -> DataFrame:
    """(vec_id, v) of the vectors that are kept."""
    x = F.col("embedding")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    whole = F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long"))
    safe = F.forall("v", lambda e: (e <= LIMIT) & (e >= -LIMIT))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x).where((F.size(x) == dim) & finite).select("vec_id", whole.alias("v"))
    return rows.select("vec_id", F.when(safe, F.col("v")).otherwise(F.raise_error(F.lit(f"a component beyond {LIMIT} after scaling"))).alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors whose hashed ids come first."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r["v"]) for r in vectors.select(mark.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()]


def _matrix(batch, dim: int) -> np.ndarray:
    return batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def moved(vectors: DataFrame, centroids: list[list[int]], dim: int) -> list[list[int]]:
    """One round: every centroid with vectors becomes the floor of their mean."""
    shared = vectors.sparkSession.sparkContext.broadcast(Tournament(centroids))

    def run(batches):
        import pyarrow as pa

        t = shared.value
        k = len(t.centroids)
        n, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            x = _matrix(batch, dim)
            best = t.winners(x)
            n += np.bincount(best, minlength=k)
            for c in np.unique(best).tolist():
                sums[c] += x[best == c].sum(axis=0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = vectors.mapInArrow(run, "cluster int, n long, sums array<long>")
    found = parts.select("cluster", "n", F.posexplode("sums").alias("i", "v")).groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    out = [list(c) for c in centroids]
    for r in found.collect():
        out[r["cluster"]][r["i"]] = int(r["v"]) // int(r["n"])
    return out


def assigned(vectors: DataFrame, centroids: list[list[int]], dim: int) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    shared = vectors.sparkSession.sparkContext.broadcast(Tournament(centroids))

    def run(batches):
        import pyarrow as pa

        t = shared.value
        for batch in batches:
            x = _matrix(batch, dim)
            best = t.winners(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best.astype(np.int32)), pa.array(t.distances(x, best))], ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    spark = vectors.sparkSession
    kept = materialize(integer_vectors(vectors, dim, scale), "vectors")
    centroids = first_centroids(kept, k, seed)
    for _ in range(rounds if centroids else 0):
        now = moved(kept, centroids, dim)
        if now == centroids:
            break  # every further round would find the same
        centroids = now
    found = materialize(assigned(kept, centroids, dim), "assigned") if centroids else spark.createDataFrame([], "vec_id long, cluster int, distance long")
    inertia = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    # k rows
    of = spark.createDataFrame([(c, inertia[c], sum(inertia.values()), digest[c]) for c in inertia], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
