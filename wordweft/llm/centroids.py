"""Centroid clustering with equal-average equal-variance search for the nearest centroid.

Vectors are whole numbers, floor(256 * x), and all distances are exact. For a vector x and a centroid c of n
components, |x - c|^2 >= n (mean x - mean c)^2 + (dev x - dev c)^2, where dev is the length of what is left
without the mean. Centroids are sorted by mean; the search starts at the vector's mean and goes outward, nearer
side first. It ends where the first term alone passes the best distance, and skips a centroid where both terms
do; the others are measured in integers. Bounds are compared with a margin for rounding, so ties are measured.

Each round is one pass over the quantised table: tasks hold the centroids (k x n numbers), and return sums and
counts per centroid, so no vector is shuffled and a cluster of any size costs k rows per task.

Kept are vectors with exactly n components, none null, NaN or infinite. Components beyond +-2^27 after scaling
count as +-2^27: with 64 components, squared distances then stay below 2^63. Repeated rows count each for itself;
a null vec_id travels as null and is hashed as empty text. Fewer kept vectors than k start fewer centroids; none
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

COMPONENTS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
LIMIT = 1 << 27
#: Vectors that are searched at a time.
BATCH = 8192


class OutwardSearch:
    """Nearest of a few centroids, exactly; ``measured`` counts the distances that were worked out in full."""

    def __init__(self, centroids: np.ndarray):
        self.count, self.width = centroids.shape
        sums = centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.centroids, self.sums = centroids[self.number], sums[self.number]
        self.means = self.sums / self.width
        self.devs = self._deviations(self.centroids, self.means)
        self.measured = 0

    @staticmethod
    def _deviations(rows: np.ndarray, means: np.ndarray) -> np.ndarray:
        return np.sqrt(((rows - means[:, None]) ** 2).sum(axis=1))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of each row; ties go to the smaller number."""
        means = x.mean(axis=1)
        devs = self._deviations(x, means)
        best = np.full(len(x), np.iinfo(np.int64).max)
        winner = np.full(len(x), self.count)
        high = np.searchsorted(self.means, means)
        low, live = high - 1, np.arange(len(x))
        while len(live):
            down = np.where(low[live] >= 0, means[live] - self.means[np.maximum(low[live], 0)], np.inf)
            up = np.where(high[live] < self.count, self.means[np.minimum(high[live], self.count - 1)] - means[live], np.inf)
            go_down = down <= up
            gap = self.width * np.minimum(down, up) ** 2
            # All centroids further out on either side are at least this far away.
            open_ = ~self._beyond(gap, best[live])
            live, go_down, gap = live[open_], go_down[open_], gap[open_]
            at = np.where(go_down, low[live], high[live])
            low[live[go_down]] -= 1
            high[live[~go_down]] += 1
            near = ~self._beyond(gap + (devs[live] - self.devs[at]) ** 2, best[live])
            rows, at = live[near], at[near]
            distance = ((x[rows] - self.centroids[at]) ** 2).sum(axis=1)
            self.measured += len(rows)
            number = self.number[at]
            better = (distance < best[rows]) | ((distance == best[rows]) & (number < winner[rows]))
            best[rows[better]], winner[rows[better]] = distance[better], number[better]
        return winner, best

    @staticmethod
    def _beyond(bound: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Is a lower bound surely above the best distance? Rounding of the bound is allowed for."""
        return bound * (1 - 1e-9) - 1 > best


def quantised(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the kept vectors as whole numbers."""
    x = F.col("embedding")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    bound = float(LIMIT)
    whole = lambda e: F.floor(F.greatest(F.least(e.cast("double") * float(scale), F.lit(bound)), F.lit(-bound))).cast("int")
    held = vectors.select("vec_id", F.when((F.size(x) == components) & finite, x).alias("x")).where("x IS NOT NULL")
    return held.select("vec_id", F.transform("x", whole).alias("v"))


def first_centroids(vectors: DataFrame, count: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The ``count`` vectors whose salted ids have the smallest hashes; ties by id, then by components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(digest.alias("h"), "vec_id", "v").orderBy("h", "vec_id", "v").limit(count).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every centroid becomes the floored mean of its vectors; an empty one stays."""
    count, width = centroids.shape

    def sums(batches):
        search = OutwardSearch(centroids)
        total, size = np.zeros((count, width), np.int64), np.zeros(count, np.int64)
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            for at in range(0, len(x), BATCH):
                part = x[at:at + BATCH]
                number, _ = search.nearest(part)
                order = np.argsort(number, kind="stable")
                present, starts = np.unique(number[order], return_index=True)
                if len(part):
                    total[present] += np.add.reduceat(part[order], starts, axis=0)
                size += np.bincount(number, minlength=count)
        held = np.flatnonzero(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held), pa.array(size[held]), pa.array(list(total[held]), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    parts = vectors.select("v").mapInArrow(sums, "cluster bigint, n bigint, total array<bigint>")
    # One row per centroid and component: counted in parts by the tasks, k x n rows for the driver.
    rows = parts.select("cluster", "n", F.posexplode("total").alias("at", "x")).groupBy("cluster", "at").agg(
        F.sum("n").alias("n"), F.sum("x").alias("x")).collect()
    centroids = centroids.copy()
    for r in rows:
        centroids[r["cluster"], r["at"]] = r["x"] // r["n"]
    return centroids


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    width = centroids.shape[1]

    def find(batches):
        search = OutwardSearch(centroids)
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            for at in range(0, len(x), BATCH):
                number, distance = search.nearest(x[at:at + BATCH])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").slice(at, BATCH), pa.array(number.astype(np.int32)), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"])

    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "v").mapInArrow(find, "vec_id bigint, cluster int, distance bigint")


def cluster(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, components: int = COMPONENTS,
            seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance), centroids) after ``rounds`` rounds of (vec_id, embedding)."""
    held = keep(quantised(vectors, components), "quantised")
    centroids = first_centroids(held, count, seed)
    if not len(centroids):
        return held.selectExpr("CAST(vec_id AS bigint) AS vec_id", "0 AS cluster", "0L AS distance"), centroids
    for _ in range(rounds):
        centroids = moved(held, centroids)
    return keep(assigned(held, centroids), "clusters"), centroids


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def report(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Every vector with the inertia of its cluster and of all, and the hash of its centroid."""
    spark = found.sparkSession
    inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    rows = [(k, inertia.get(k, 0), sum(inertia.values()), digest(c)) for k, c in enumerate(centroids)]
    per_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
