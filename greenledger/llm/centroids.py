"""Centroid clustering with exact integer distances, nearest centroids by Orchard's search.

Each centroid has the list of all others, nearest first. A vector starts at
some centroid and walks its list: every centroid not yet visited is measured and
marked; a closer one takes over, and the walk starts again at the head of its
list. It stops where the list's next centroid is strictly farther from the
current one than twice the vector's distance: by the triangle inequality
neither it nor any later one can be as near. Equally near centroids lie within that
bound, so ties are seen and go to the smaller number.

Squared distances are integers, hence the test is ``gap > 4 * distance`` and
nothing is rounded. All vectors of an Arrow batch walk at once.

The start is the centroid nearest in the leading components, an eighth of the work
of one comparison with all centroids; it has no influence on the result. A
round passes on one row of sums per task and centroid; the driver holds the
centroids only. Vectors are read in every round and never moved.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.llm.common import written
from greenledger.llm.vectors import as_integers, integer_rows, squared, usable

#: Rows that walk together: bounds the memory of a task.
STEP = 8192

RESULT = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


class Orchard:
    """Nearest-centroid search over integer centroids (k, dims)."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k = len(centroids)
        gaps = np.stack([squared(centroids, c) for c in centroids])
        others = [np.delete(np.arange(k), c) for c in range(k)]
        self.lists = np.array([o[np.argsort(gaps[c, o], kind="stable")] for c, o in enumerate(others)], np.int64)
        self.gaps = np.take_along_axis(gaps, self.lists, 1) if k > 1 else np.zeros((k, 0), np.int64)
        self.lead = max(1, centroids.shape[1] // 8)
        self.measured = 0

    def start(self, x: np.ndarray) -> np.ndarray:
        return squared(x[:, None, :self.lead], self.centroids[None, :, :self.lead]).argmin(1)

    def nearest(self, x: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance) of each row."""
        n, ends = len(x), self.lists.shape[1]
        at = self.start(x) if start is None else start.copy()
        best = squared(x, self.centroids[at])
        place = np.zeros(n, np.int64)
        visited = np.zeros((n, len(self.centroids)), bool)
        visited[np.arange(n), at] = True
        self.measured += n
        walking = np.arange(n)
        while True:
            walking = walking[place[walking] < ends]
            walking = walking[self.gaps[at[walking], place[walking]] <= 4 * best[walking]]
            if not len(walking):
                return at, best
            met = self.lists[at[walking], place[walking]]
            place[walking] += 1
            new = ~visited[walking, met]
            rows, met = walking[new], met[new]
            visited[rows, met] = True
            self.measured += len(rows)
            far = squared(x[rows], self.centroids[met])
            closer = (far < best[rows]) | ((far == best[rows]) & (met < at[rows]))
            rows = rows[closer]
            at[rows], best[rows], place[rows] = met[closer], far[closer], 0


def _assigned(centroids, dims: int, scale: int):
    def run(batches):
        search = Orchard(centroids)
        for batch in batches:
            kept, x = integer_rows(batch.column(1), dims, scale)
            ids = batch.column(0).filter(pa.array(kept))
            for lo in range(0, len(x), STEP):
                at, far = search.nearest(x[lo:lo + STEP])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, STEP), pa.array(at, pa.int32()), pa.array(far, pa.int64())], ["id", "cluster", "distance"])
    return run


def _sums(centroids, dims: int, scale: int):
    def run(batches):
        search, k = Orchard(centroids), len(centroids)
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            _, x = integer_rows(batch.column(1), dims, scale)
            for lo in range(0, len(x), STEP):
                part = x[lo:lo + STEP]
                at, _ = search.nearest(part)
                np.add.at(total, at, part)
                count += np.bincount(at, minlength=k)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(count[used], pa.int64()), pa.array(list(total[used]), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"])
    return run


def moved(centroids: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Centroids replaced by floor(sum / count); ``sums`` has (cluster, n, sums) per
    task. k * dims numbers reach the driver, whatever the data."""
    whole = sums.select("cluster", "n", F.posexplode("sums").alias("place", "s")).groupBy("cluster", "place").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"))
    out = centroids.copy()
    for r in whole.collect():
        out[r["cluster"], r["place"]] = r["s"] // r["n"]
    return out


def first_centroids(vectors: DataFrame, k: int, dims: int, scale: int, salt: str) -> np.ndarray:
    """The ``k`` kept vectors with the smallest sha256 of ``<salt><id>``, in that
    order (null ids last, equal ids by their components)."""
    order = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    kept = vectors.filter(usable("vector") & (F.size("vector") == dims))
    first = kept.select("vector", order.alias("h")).orderBy(F.asc_nulls_last("h"), "vector").limit(k).collect()
    return as_integers([r["vector"] for r in first], scale).reshape(-1, dims)


def cluster_vectors(df: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, salt: str = "2:",
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col``, cluster, distance, cluster_inertia, inertia and centroid_sha256 of
    every vector with exactly ``dims`` components, none null or non-finite.

    Components become floor(scale * x). ``rounds`` times all vectors are assigned
    and every centroid with vectors moves to the floor of their mean; then they
    are assigned once more. Other vectors (null, empty, of another length) are
    left out. Ids may be null or repeated: each row is a vector of its own.
    Fewer kept vectors than ``k`` give fewer centroids; equal starting vectors
    stay centroids of their own, the larger number empty. No kept vector gives an
    empty result. Other columns are ignored, whatever their names.
    """
    spark = df.sparkSession
    vectors = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    kind = vectors.schema["id"].dataType.simpleString()
    centroids = first_centroids(vectors, k, dims, scale, salt)
    if not len(centroids):
        return spark.createDataFrame([], f"`{id_col}` {kind}, {RESULT}")
    for _ in range(rounds):
        centroids = moved(centroids, vectors.mapInArrow(
            _sums(centroids, dims, scale), "cluster int, n long, sums array<long>"))
    found = written(vectors.mapInArrow(
        _assigned(centroids, dims, scale), f"id {kind}, cluster int, distance long"), "centroids")
    sizes = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    # One row per centroid: k at most.
    named = spark.createDataFrame(
        [(c, sizes[c], sum(sizes.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
         for c in sorted(sizes)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(named), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
