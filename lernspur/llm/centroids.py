"""Centroid clustering in exact integers, by a distance matrix that is only ever updated.

Each vector keeps its integer dot products with all centroids in a stored table. When centroids have moved, a
dot product is changed by the vector's components times the centroid's change, over the components that did
change and no others; squared distances follow from it and from the two squared lengths, and the nearest centroid
is found anew. Sums per centroid are kept as well: only vectors that went from one centroid to another are added
and taken away. Nothing is rounded but the centroids themselves, by the floor that defines them, so the result
does not depend on partitions, batches or the order of rows. When no component of any centroid changes, no later
round would change anything, and the rounds end.

Only k centroids and their sums come to the driver. No rows are shuffled, so a vector that repeats very often weighs
on no task. A round's table is deleted when the next one is stored, which a lost executor does not need any more.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lernspur.runtime import forget, materialize

DIMENSIONS = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SEED = "3:"
# Integers stay below this, so that 64 squares of differences fit a long; larger ones are an error.
LARGEST = 1 << 27

_STATE = "vec_id long, v array<int>, norm long, dots array<bigint>, before int, cluster int, distance long"


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the vectors with just so many components, none null or non-finite, as floor(scale * x)."""
    x = F.col("embedding")
    whole = (F.size(x) == dimensions) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    fits = F.forall(scaled, lambda c: F.abs(c) < LARGEST)
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding")).where(whole)
    return kept.select("vec_id", F.when(fits, scaled).otherwise(
        F.raise_error(F.lit(f"a component times {scale} is {LARGEST} or more"))).cast("array<int>").alias("v"))


def first_centroids(kept: DataFrame, count: int = CENTROIDS, seed: str = SEED) -> list[list[int]]:
    """The vectors whose ids, after ``seed``, have the smallest SHA-256; null ids come last, ties by components."""
    by = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    return [list(r.v) for r in kept.orderBy(by.asc_nulls_last(), "v").select("v").limit(count).collect()]


def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _lists(matrix: np.ndarray, kind) -> pa.ListArray:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel(), kind))


def _update(state: DataFrame, centroids: np.ndarray, change: np.ndarray) -> DataFrame:
    """``state`` with dot products brought forward by ``change`` and the nearest of ``centroids`` for each row."""
    count, width = centroids.shape
    lengths = (centroids * centroids).sum(axis=1)
    moved = [(j, np.flatnonzero(change[j])) for j in range(count) if change[j].any()]

    def nearest(batches):
        for batch in batches:
            v, dots = _matrix(batch.column("v"), width), _matrix(batch.column("dots"), count)
            for j, at in moved:
                dots[:, j] += v[:, at] @ change[j, at]
            norm = batch.column("norm").to_numpy(zero_copy_only=False)
            far = norm[:, None] - 2 * dots + lengths
            cluster = far.argmin(axis=1) if len(far) else np.zeros(0, np.int64)  # the first of equals
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), batch.column("norm"), _lists(dots, pa.int64()),
                 batch.column("cluster"), pa.array(cluster, pa.int32()),
                 pa.array(np.take_along_axis(far, cluster[:, None], 1).ravel(), pa.int64())],
                names=["vec_id", "v", "norm", "dots", "before", "cluster", "distance"])

    return state.mapInArrow(nearest, _STATE)


def _moved_sums(state: DataFrame, count: int, width: int) -> dict[tuple[int, int], int]:
    """What vectors that changed their cluster add to each (cluster, component); the count is component -1."""
    def sums(batches):
        total = np.zeros((count, width + 1), np.int64)
        for batch in batches:
            v = _matrix(batch.column("v"), width)
            for name, sign in (("cluster", 1), ("before", -1)):
                place = batch.column(name).to_numpy(zero_copy_only=False)
                for j in range(count):
                    own = place == j
                    total[j, :width] += sign * v[own].sum(axis=0)
                    total[j, width] += sign * int(own.sum())
        at, i = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"j": at.astype(np.int32), "i": i.astype(np.int32), "s": total[at, i]})

    parts = state.where("cluster <> before").select("v", "cluster", "before").mapInArrow(sums, "j int, i int, s long")
    total = parts.groupBy("j", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    return {(r.j, r.i): int(r.s) for r in total.collect()}


_RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def cluster_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE, count: int = CENTROIDS,
                    rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    ``vectors`` has vec_id and embedding; other columns are ignored whatever their names. Vectors of another
    length, null ones and those with null or non-finite components have no row. Repeated rows, ids and null ids
    are vectors like others. With fewer than ``count`` vectors each is a centroid; with none the result is empty.
    """
    spark = vectors.sparkSession
    kept = integer_vectors(vectors, dimensions, scale)
    squares = F.aggregate(F.transform("v", lambda c: c.cast("long") * c), F.lit(0).cast("long"), lambda a, b: a + b)
    state = materialize(kept.withColumn("norm", squares))
    first = first_centroids(state, count, seed)
    if not first:
        return spark.createDataFrame([], _RESULT)
    now = np.array(first, np.int64)
    change, sums = now, np.zeros((len(now), dimensions + 1), object)
    nothing = F.lit(-1).cast("int")
    before = state.select("vec_id", "v", "norm", F.array_repeat(F.lit(0).cast("long"), len(now)).alias("dots"),
                          nothing.alias("before"), nothing.alias("cluster"))
    stored = state
    for turn in range(rounds + 1):
        after = materialize(_update(before, now, change))
        forget(stored)
        before = stored = after
        if turn == rounds:
            break
        for (j, i), s in _moved_sums(after, len(now), dimensions).items():
            sums[j, i] += s
        then = now.copy()
        for j in np.flatnonzero(sums[:, dimensions] > 0):
            then[j] = [int(s) // int(sums[j, dimensions]) for s in sums[j, :dimensions]]
        change, now = then - now, then
        if not change.any():
            break
    spread = {r.cluster: int(r.s) for r in after.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    named = [(j, s, sum(spread.values()), hashlib.sha256(",".join(map(str, now[j].tolist())).encode()).hexdigest())
             for j, s in spread.items()]
    # One row for each centroid.
    about = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return after.select("vec_id", "cluster", "distance").join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
