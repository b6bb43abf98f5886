"""Exact k-means over whole-number vectors, by balls.

A cluster is a ball: its centroid and the distance of its farthest member. A member x of ball i
cannot lie nearer to centroid j than to its own unless ``2 |x - c_i| >= |c_i - c_j|``. So only
centroids within twice the radius are neighbours of a ball; members nearer to their centroid
than half the way to the nearest neighbour are its stable core, which is compared with nothing,
and those in the annulus behind the half way to the m-th neighbour are compared with the m
nearest ones alone. Neighbours that have not moved since the round before, to a centroid that has
not moved either, cannot win members and are skipped. All comparisons are of whole numbers, so
the result equals plain k-means.

Balls are built over the members in an Arrow batch: a smaller radius than the whole cluster's,
which prunes more and needs no pass of its own. A round is one job over the vectors with the
cluster they were in; it is persisted on disk until the next round has read it. If an executor
and its part are lost, Spark computes that part anew from the table.

Vectors that are null, have another length or hold null, NaN or infinite components (also after
scaling) are left out. Repeated rows all count. Rows without vec_id take part, but start no
cluster unless there are too few others. An empty table gives no rows; fewer vectors than k
give as many clusters. Distances and sums that 64 bits cannot hold are returned as null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.shared import ready, stored

#: Whole numbers up to this give squared distances of 64 components that float64 holds exactly.
SMALL = 1 << 22
LONG = (1 << 63) - 1


def finite(width: int | None, scale: int):
    """Whether column embedding has only finite components, scaled or not, and the width if one is given."""
    bound = np.finfo(np.float64).max / scale
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= bound))
    return good if width is None else (F.size("embedding") == width) & good


def whole(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of the components, as float64 (always exact for a power of two)."""
    return np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).reshape(-1, width)


def exact(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as float64 if sums of squares stay exact, as Python's whole numbers else."""
    if max(np.abs(points).max(initial=0), max((abs(int(x)) for x in centres.flat), default=0)) < SMALL:
        return points, centres.astype(np.float64)
    ints = np.frompyfunc(int, 1, 1)
    return ints(points), ints(centres)


def squares(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = points - centre
    return (gap * gap).sum(axis=1)


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance by comparison with every centroid; the smaller number of two as near."""
    cluster, best = np.zeros(len(points), np.int32), squares(points, centres[0])
    for j in range(1, len(centres)):
        other = squares(points, centres[j])
        closer = (other < best).astype(bool)
        cluster[closer], best[closer] = j, other[closer]
    return cluster, best


def by_balls(points: np.ndarray, own: np.ndarray, centres: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """As ``nearest`` for points that were nearest to ``own`` before the centroids flagged in ``moved`` moved; and the number of comparisons."""
    cluster, best, made = own.copy(), np.empty(len(points), points.dtype), 0
    for i in np.unique(own):
        members = np.flatnonzero(own == i)
        distance = squares(points[members], centres[i])
        order = np.argsort(distance, kind="stable")
        members, distance = members[order], distance[order]
        cluster[members], best[members] = i, distance
        made += len(members)
        apart = squares(centres, centres[i])
        half = [(-(-int(apart[j]) // 4), j) for j in range(len(centres)) if j != i and (moved[i] or moved[j])]
        for least, j in sorted(h for h in half if h[0] <= distance[-1]):
            reach = members[np.searchsorted(distance, least, "left") :]
            other = squares(points[reach], centres[j])
            closer = ((other < best[reach]) | ((other == best[reach]) & (j < cluster[reach]))).astype(bool)
            cluster[reach[closer]], best[reach[closer]] = j, other[closer]
            made += len(reach)
    return cluster, best, made


def assigner(centres: np.ndarray, moved: np.ndarray | None, width: int, scale: int, last: bool) -> Callable:
    """A task's work of a round. Rows come with their cluster, or without one before the first round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points, at = exact(whole(batch.column("embedding"), width, scale), centres)
            if moved is None:
                cluster, distance = nearest(points, at)
            else:
                cluster, distance, _ = by_balls(points, batch.column("cluster").to_numpy(zero_copy_only=False), at, moved)
            if last:
                fit = [int(d) if d <= LONG else None for d in distance] if distance.dtype == object else distance.astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(fit, pa.int64())], ["vec_id", "cluster", "distance"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.array(cluster, pa.int32())], ["vec_id", "embedding", "cluster"])

    return run


def means(state: DataFrame, centres: np.ndarray, width: int, scale: int) -> np.ndarray:
    """The exact floors of the clusters' means; of an empty cluster its old centroid.

    A task adds up its own vectors; Spark adds these sums, k times width of them from each task.
    """

    def add(batches):
        total, count = np.zeros((len(centres), width), object), np.zeros(len(centres), np.int64)
        for batch in batches:
            points, _ = exact(whole(batch.column("embedding"), width, scale), centres[:0])
            cluster = batch.column("cluster").to_numpy(zero_copy_only=False)
            for i in np.unique(cluster):
                mine = points[cluster == i]
                total[i] += mine.astype(np.int64).sum(axis=0).astype(object) if mine.dtype != object else mine.sum(axis=0)
                count[i] += len(mine)
        rows = [(int(i), j, str(total[i, j]), int(count[i])) for i in np.flatnonzero(count) for j in range(width)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["cluster", "place", "total", "n"])

    parts = state.mapInArrow(add, "cluster long, place long, total string, n long")
    out = centres.copy()
    for row in parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect():
        out[row.cluster, row.place] = int(row.total) // row.n
    return out


def ball_kmeans(vectors: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, salt: str = "3:") -> DataFrame:
    """(vec_id, cluster, distance, centroid, cluster_inertia, inertia) of vectors (vec_id, embedding).

    Components become floor(scale * x), scale a power of two. Centroids start as the k vectors of
    smallest sha256 of ``salt`` and vec_id. Each round assigns every vector and moves centroids to
    the floors of the means; then vectors are assigned once more. A round in which none moves is
    the last that is needed.
    """
    spark = ready(vectors.sparkSession)
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    kept = vectors.select("vec_id", F.col("embedding").cast(kind).alias("embedding")).where(finite(width, scale))
    hashed = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    # k rows of bounded width.
    first = kept.orderBy(hashed.asc_nulls_last(), "embedding").limit(k).collect()
    ints = np.frompyfunc(int, 1, 1)
    centres = np.array([[int(np.floor(x * scale)) for x in r.embedding] for r in first], object).reshape(len(first), width)
    result = "vec_id {}, cluster int, distance long".format(dict(vectors.dtypes)["vec_id"])
    if not first:
        return spark.createDataFrame([], f"{result}, centroid array<long>, cluster_inertia long, inertia long")
    schema, state, moved = kept.select("*", F.lit(0).alias("cluster")).schema, kept, None
    held: list[DataFrame] = []
    try:
        for _ in range(rounds):
            state = state.mapInArrow(assigner(centres, moved, width, scale, False), schema).persist(StorageLevel.DISK_ONLY)
            held.append(state)
            new = means(state, centres, width, scale)
            for old in held[:-1]:
                old.unpersist()
            held, moved, centres = held[-1:], (new != centres).any(axis=1), ints(new)
            if not moved.any():
                break
        assigned = stored(state.mapInArrow(assigner(centres, moved, width, scale, True), result), "clusters")
    finally:
        for old in held:
            old.unpersist()
    found = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    fit = lambda x: int(x) if x is not None and x <= LONG else None
    whole_sum = fit(sum(found.values())) if all(x is not None for x in found.values()) else None
    rows = [(int(i), [int(x) if abs(x) <= LONG else None for x in centres[i]], fit(found[i]), whole_sum) for i in sorted(found)]
    balls = spark.createDataFrame(rows, "cluster int, centroid array<long>, cluster_inertia long, inertia long")
    return assigned.join(F.broadcast(balls), "cluster").select("vec_id", "cluster", "distance", "centroid", "cluster_inertia", "inertia")  # k rows
