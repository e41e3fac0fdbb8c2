"""K-means over integer vectors, nearest centroids found in order of their means.

The squared distance of two vectors is at least k times the squared difference of their
means plus the squared difference of their deviations (the lengths of what is left of
a vector when its mean is taken off). So centroids are sorted by mean, and each
vector looks at them outward from its own mean. A centroid whose bound is above the
best distance so far is passed over; beyond the first whose mean alone excludes it, all on that
side are. Those that stay are compared exactly, in integers.

Components are small integers, sums and floors are exact, and of equal distances the
centroid of the smaller number counts, so the result does not depend on the order of rows
or on how they are partitioned. To the driver come the centroids and sums of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, named, ship

SIZE = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
#: Components are held within this range, so that every squared distance fits 64 bits.
MOST = 2**27

_FAR = int(np.iinfo(np.int64).max)


def integer_vectors(vectors: DataFrame, size: int = SIZE, scale: int = SCALE,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and vector (array of int) of the rows with ``size`` components, all finite."""
    vector = named(vector_col)
    fine = (F.size(vector) == size) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.greatest(F.lit(-MOST), F.least(
        F.lit(MOST), F.floor(F.greatest(F.lit(-2.0 * MOST), F.least(F.lit(2.0 * MOST), x.cast("double") * float(scale))))
    )).cast("int"))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(named(id_col).cast("long").alias("vec_id"), whole.alias("vector"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = 1) -> np.ndarray:
    """The vectors whose ids have the smallest SHA-256, in that order (equal ids: by their components)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(digest.alias("digest"), "vector").orderBy("digest", "vector").limit(clusters).collect()
    return np.array([r.vector for r in rows], np.int64)


@dataclass
class MeanOrder:
    """Centroids sorted by mean, with what the bounds need: component sums and scaled deviations."""

    centroids: np.ndarray

    def __post_init__(self) -> None:
        sums = self.centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.sorted = self.centroids[self.number]
        self.sums, self.deviations = moments(self.sorted)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each vector's nearest centroid, and how many distances were taken."""
        count, size = len(self.sorted), vectors.shape[1]
        sums, deviations = moments(vectors)
        best, at = np.full(len(vectors), _FAR), np.full(len(vectors), count)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        open_, taken = np.arange(len(vectors)), 0
        while open_.size:
            # The side whose next mean is nearer; a side that has ended is infinitely far.
            to_left = np.where(left[open_] >= 0, sums[open_] - self.sums[np.maximum(left[open_], 0)], _FAR)
            to_right = np.where(right[open_] < count, self.sums[np.minimum(right[open_], count - 1)] - sums[open_], _FAR)
            go_left = to_left <= to_right
            step = np.where(go_left, left[open_], right[open_])
            gap = np.where(go_left, to_left, to_right)
            # In floats with a margin: only what is surely farther is passed over, the rest is compared exactly.
            limit = best[open_].astype(float) * size * (1 + 1e-9) + 1
            by_mean = gap.astype(float) ** 2
            inside = (gap != _FAR) & (by_mean <= limit)
            open_, step, go_left, limit, by_mean = open_[inside], step[inside], go_left[inside], limit[inside], by_mean[inside]
            left[open_[go_left]] -= 1
            right[open_[~go_left]] += 1
            near = by_mean + (deviations[open_] - self.deviations[step]) ** 2 <= limit
            who, which = open_[near], step[near]
            taken += who.size
            distance = ((vectors[who] - self.sorted[which]) ** 2).sum(axis=1)
            number = self.number[which]
            better = (distance < best[who]) | ((distance == best[who]) & (number < at[who]))
            best[who[better]], at[who[better]] = distance[better], number[better]
        return at, best, taken


def moments(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component sums, and deviations times the root of the size."""
    sums = vectors.sum(axis=1)
    size = vectors.shape[1]
    squares = (vectors.astype(float) ** 2).sum(axis=1) * size - sums.astype(float) ** 2
    return sums, np.sqrt(np.maximum(squares, 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    vectors = batch.column("vector")
    return vectors.flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, -1)


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance (squared) of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = MeanOrder(centroids)
        for batch in batches:
            if batch.num_rows:
                number, distance, _ = order.nearest(_matrix(batch))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"]
                )

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the floor of its vectors' mean; one without vectors stays.

    Tasks send a row of sums for each cluster and batch, which are added up before and
    after the shuffle: a cluster of any size is no group that a task holds.
    """
    size = centroids.shape[1]
    names = [f"s{k}" for k in range(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = MeanOrder(centroids)
        total, count = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            if batch.num_rows:
                matrix = _matrix(batch)
                number, _, _ = order.nearest(matrix)
                np.add.at(total, number, matrix)
                count += np.bincount(number, minlength=len(count))
        found = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int32)), pa.array(count[found]), *[pa.array(total[found, k]) for k in range(size)]],
            ["cluster", "n", *names],
        )

    kind = ", ".join(["cluster int", "n long", *[f"{name} long" for name in names]])
    rows = vectors.mapInArrow(run, kind).groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(name).alias(name) for name in names]).collect()
    out = centroids.copy()
    for row in rows:
        out[row.cluster] = [row[name] // row.n for name in names]
    return out


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 1, size: int = SIZE,
              scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each usable vector.

    Vectors that are null, of another size, or hold null or non-finite components have no
    row. Repeated rows count and come out each; a null id hashes as an empty text; of equal
    distances the smaller number counts. With fewer vectors than ``clusters`` there are as
    many centroids as vectors; an empty table gives no rows. Components beyond 2**27 are held
    there. An inertia that does not fit a long is null. Other columns are left out.
    """
    spark = vectors.sparkSession
    ship(spark)
    whole = materialise(integer_vectors(vectors, size, scale, id_col, vector_col), "integer-vectors")
    centroids = first_centroids(whole, clusters, seed)
    if not len(centroids):
        centroids = np.zeros((1, size), np.int64)
    for _ in range(rounds):
        centroids = moved(whole, centroids)
    found = materialise(assigned(whole, centroids), "clusters")
    # A row for each centroid, no more.
    own = {r.cluster: r.own for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("own")).collect()}
    whole_sum = _fitting(sum(map(int, own.values())))
    table = spark.createDataFrame(
        [(k, _fitting(int(n)), whole_sum, centroid_digest(centroids[k])) for k, n in own.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _fitting(n: int) -> int | None:
    return n if n <= _FAR else None
