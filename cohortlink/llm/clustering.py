"""Centroid clustering of integer vectors; the nearest centroid is found by the threshold algorithm.

For every dimension the centroids are kept as a list sorted by their value in
it. A vector's nearest centroid is sought by walking each list outward from the
vector's own value. A centroid met for the first time is measured exactly. No
centroid that is still unmet can be nearer than the sum, over the dimensions,
of the squared distance to the list's frontier, so the walk ends when that sum
strictly exceeds the best exact distance; at equality an unmet centroid of a
smaller number could still tie.

A round is one pass over the vectors. Each task adds up its own vectors by
cluster, so a round shuffles k x dimensions numbers per task, whatever the size
of a cluster; the driver holds the k centroids only.

Hard rows: a null vector, one of another length or with a null or non-finite
component is left out. A vector without an id is clustered and returned, yet is
no start. Repeated rows count as often as they occur. With fewer than k
vectors there are as many centroids as vectors; an empty table gives no rows.
Components of 2**27 and more, whose squared distance may not fit a long, raise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

LIMIT = 1 << 27
# Vectors that one numpy pass works on.
BLOCK = 1024
NONE = np.iinfo(np.int64).max


def whole_components(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """Each component as the integer floor(scale * x), x taken as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint"))


def rows_of(column: pa.Array, dims: int) -> np.ndarray:
    """A list column, all of one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


class CentroidLists:
    """Per dimension the centroids in order of their value in it."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, dtype=np.int64)
        self.order = np.argsort(self.centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(self.centroids, self.order, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of, and squared distance to, the nearest centroid of each vector; ties go to the smaller number."""
        if len(vectors) and max(-int(vectors.min()), int(vectors.max())) >= LIMIT:
            raise ValueError("a component is too large: squared distances would not fit a long")
        parts = [self._nearest(vectors[at : at + BLOCK]) for at in range(0, len(vectors), BLOCK)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        numbers, distances = zip(*parts, strict=True)
        return np.concatenate(numbers), np.concatenate(distances)

    def _nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, dims = self.centroids.shape
        dim = np.arange(dims)
        # above: the next list entry at or over the vector's value; below: the next one under it
        above = np.empty(vectors.shape, dtype=np.int64)
        for d in range(dims):
            above[:, d] = np.searchsorted(self.values[:, d], vectors[:, d])
        below = above - 1
        exact = np.full((len(vectors), k), NONE)
        met = np.zeros((len(vectors), k), dtype=bool)
        open_ = np.arange(len(vectors))
        for _ in range(k):  # each step takes one entry of every list; after k steps all are taken
            x, up, down = vectors[open_], above[open_], below[open_]
            gap_up = np.where(up < k, self.values[np.minimum(up, k - 1), dim] - x, NONE)
            gap_down = np.where(down >= 0, x - self.values[np.maximum(down, 0), dim], NONE)
            goes_down = gap_down <= gap_up
            taken = np.where(goes_down, down, up)
            above[open_] += ~goes_down
            below[open_] -= goes_down
            now = np.zeros((len(open_), k), dtype=bool)
            np.put_along_axis(now, self.order[taken, dim], True, axis=1)
            row, number = np.nonzero(now & ~met[open_])
            difference = x[row] - self.centroids[number]
            exact[open_[row], number] = (difference * difference).sum(axis=1)
            met[open_] |= now
            frontier = np.minimum(gap_up, gap_down)
            open_ = open_[(frontier * frontier).sum(axis=1) <= exact[open_].min(axis=1)]
            if not len(open_):
                break
        numbers = exact.argmin(axis=1)
        return numbers, exact[np.arange(len(vectors)), numbers]


def _totals(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(cluster, place, total, count): the sum of each component over the vectors of each non-empty cluster."""
    dims = len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = CentroidLists(centroids)
        totals = np.zeros((len(centroids), dims), dtype=np.int64)
        counts = np.zeros(len(centroids), dtype=np.int64)
        for batch in batches:
            rows = rows_of(batch.column(0), dims)
            numbers, _ = lists.nearest(rows)
            np.add.at(totals, numbers, rows)
            counts += np.bincount(numbers, minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {"cluster": used.astype(np.int32), "totals": totals[used].tolist(), "n": counts[used]},
            schema=pa.schema([("cluster", pa.int32()), ("totals", pa.list_(pa.int64())), ("n", pa.int64())]),
        )

    parts = vectors.select("vector").mapInArrow(run, "cluster int, totals array<bigint>, n bigint")
    each = parts.select("cluster", "n", F.posexplode("totals").alias("place", "total"))
    return each.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def cluster_vectors(
    table: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = 64,
    k: int = 16,
    rounds: int = 3,
    scale: int = 64,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid), a row per kept vector.

    The k starts are the vectors with the smallest hash of their id; each of
    ``rounds`` rounds replaces a non-empty cluster's centroid by the floor of
    its vectors' mean.
    """
    spark = table.sparkSession
    given = table.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vector"))
    given = given.where(whole_components(F.col("vector")) & (F.size("vector") == dims))
    vectors = written(given.select("vec_id", scaled(F.col("vector"), scale).alias("vector")), "vectors")

    place = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = vectors.where("vec_id is not null").select("vector", place.alias("place"))
    centroids = [list(r["vector"]) for r in first.orderBy("place", "vector").limit(k).collect()]
    schema = "vec_id bigint, cluster int, distance bigint"
    model = "cluster int, centroid_sha256 string, centroid array<bigint>, cluster_inertia bigint, inertia bigint"
    if not centroids:
        empty = spark.createDataFrame([], f"{schema}, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
        return empty.withColumn("centroid", F.lit(None).cast("array<bigint>"))
    for _ in range(rounds):
        for r in _totals(vectors, centroids).collect():
            centroids[r["cluster"]][r["place"]] = r["total"] // r["n"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = CentroidLists(centroids)
        for batch in batches:
            numbers, distances = lists.nearest(rows_of(batch.column(1), dims))
            columns = [batch.column(0), pa.array(numbers.astype(np.int32)), pa.array(distances)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    assigned = written(vectors.mapInArrow(assign, schema), "clusters")
    sums = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    rows = [
        (j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest(), c, sums[j], sum(sums.values()))
        for j, c in enumerate(centroids)
        if j in sums
    ]
    # k rows
    return assigned.join(F.broadcast(spark.createDataFrame(rows, model)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"
    )
