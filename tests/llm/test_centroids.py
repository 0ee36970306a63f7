"""Centroid clustering against brute force in Python integers."""

import hashlib
import math

import numpy as np
import pytest

from lernspur.llm import centroids

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, dimensions, count, rounds=10, scale=1024):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in e]) for i, e in rows
            if e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) for x in e)]

    def place(row):
        return row[0] is None, hashlib.sha256(f"3:{row[0]}".encode()).hexdigest(), row[1]

    means = [v for _, v in sorted(kept, key=place)[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(means))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, own in groups.items():
            means[j] = [sum(x) // len(own) for x in zip(*own)]
    out = [(i, *reversed(nearest(v))) for i, v in kept]
    spread = {}
    for _, j, d in out:
        spread[j] = spread.get(j, 0) + d
    return [(i, j, d, spread[j], sum(spread.values()),
             hashlib.sha256(",".join(map(str, means[j])).encode()).hexdigest()) for i, j, d in out]


def check(df, dimensions=4, **options):
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    got = [tuple(r) for r in centroids.cluster_vectors(df, dimensions, **options).collect()]
    count = options.get("count", centroids.CENTROIDS)
    assert sorted(got, key=repr) == sorted(brute(rows, dimensions, count), key=repr)


def test_random(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(i % 5, 0.4, 4)]) for i in range(300)]
    check(spark.createDataFrame(rows, VECTORS).repartition(5))
    check(spark.createDataFrame(rows, VECTORS), count=3)


def test_awkward(spark):
    """Nulls, other lengths, non-finite components, repeated rows and ids, ties, one very common vector, empty clusters."""
    one, zero = [1.0, -1.0, 0.5, -0.25], [0.0, 0.0, 0.0, 0.0]
    rows = [(1, None), (2, []), (3, one[:3]), (4, [*one, 1.0]), (5, [1.0, None, 0.0, 0.0]), (6, [float("nan"), *one[1:]]),
            (7, [float("inf"), *one[1:]]), (8, [-float("inf"), *one[1:]]), (None, one), (None, zero), (None, None),
            (9, one), (9, one), (9, zero), (10, zero), (11, [-0.0001, 0.0001, 0.0, 0.0])]
    rows += [(100 + i, one) for i in range(200)]
    df = spark.createDataFrame(rows, VECTORS)
    check(df)
    check(df, count=2)
    from pyspark.sql import functions as F

    clashing = df.select("*", *[F.lit(7).alias(c) for c in ("v", "norm", "dots", "before", "cluster", "distance", "j", "i", "s")])
    check(clashing)


def test_few_and_none(spark):
    check(spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0]), (2, [0.0, 0.0, 0.0, 1.0])], VECTORS))
    none = centroids.cluster_vectors(spark.createDataFrame([(1, [1.0])], VECTORS))
    assert none.count() == 0
    assert none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_only_changed_components_move(spark):
    """The kept products equal those computed anew, for a change in a few components."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 4)]) for i in range(50)]
    state = centroids.integer_vectors(spark.createDataFrame(rows, VECTORS), 4)
    old, new = np.array([[5, 6, 7, 8], [1, 2, 3, 4]]), np.array([[5, 9, 7, 8], [1, 2, 3, 4]])

    def full(v):
        return [sum(a * b for a, b in zip(v, m)) for m in old.tolist()]

    held = [(r.vec_id, list(r.v), sum(x * x for x in r.v), full(r.v), -1, -1, 0) for r in state.collect()]
    for r in centroids._update(spark.createDataFrame(held, centroids._STATE), new, new - old).collect():
        assert r.dots == [sum(a * b for a, b in zip(r.v, m)) for m in new.tolist()]
        assert (r.distance, r.cluster) == min((sum((a - b) ** 2 for a, b in zip(r.v, m)), j) for j, m in enumerate(new.tolist()))


def test_too_large(spark):
    with pytest.raises(Exception, match="134217728 or more"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [1e9, 0.0, 0.0, 0.0])], VECTORS), 4)
