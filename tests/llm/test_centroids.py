"""Centroid clustering against a plain version, its filter, and odd vectors."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakesieve.llm import centroids


def plain(rows, k, rounds, scale=256):
    """What the contract says, one vector after another. ``rows`` are (id, list of numbers)."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows]
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    points = [v for _, v in kept[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        held = {}
        for _, v in kept:
            held.setdefault(nearest(v)[1], []).append(v)
        points = [[sum(c) // len(held[n]) for c in zip(*held[n])] if n in held else p for n, p in enumerate(points)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    sums = {c: sum(d for _, x, d in found if x == c) for _, c, _ in found}
    name = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted([(i, c, d, sums[c], sum(sums.values()), name[c]) for i, c, d in found], key=str)


def found(df, **named):
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted([tuple(r) for r in centroids.cluster(df, **named).select(*columns).collect()], key=str)


def vectors(seed, n, dimensions, spread):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(dimensions)] for _ in range(5)]
    return [(i, [float(np.float32(m + rng.gauss(0, spread))) for m in rng.choice(middles)]) for i in range(n)]


@pytest.mark.parametrize("n,dimensions,k,spread", [(300, 8, 12, 0.1), (200, 3, 40, 0.01), (5, 4, 9, 0.3), (90, 1, 6, 0.5)])
def test_as_a_plain_version(spark, n, dimensions, k, spread):
    rows = vectors(n, n, dimensions, spread)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    assert found(df, k=k, rounds=3, dimensions=dimensions) == plain(rows, k, 3)


def test_ties_repeats_null_ids_and_clashing_columns(spark):
    rows = [(i // 2, [float(i % 4), 0.0]) for i in range(40)] + [(None, [1.0, 0.0]), (None, [9.0, 9.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    df = df.selectExpr("*", "'x' as cluster", "0 as distance", "1 as id", "2 as v", "3 as short", "'y' as inertia")
    assert found(df, k=6, rounds=4, dimensions=2) == plain(rows, 6, 4)


def test_only_whole_vectors_are_kept(spark):
    good = [1.0, 2.0]
    rows = [(1, good), (2, None), (3, []), (4, [1.0]), (5, [1.0, 2.0, 3.0]), (6, [1.0, None]), (7, [float("nan"), 1.0]),
            (8, [1.0, float("inf")]), (9, [float("-inf"), 1.0]), (10, [-0.001, 0.001])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert found(df, k=3, rounds=2, dimensions=2) == plain([rows[0], rows[9]], 3, 2)
    none = centroids.cluster(df.where("vec_id between 2 and 9"), dimensions=2)
    assert none.count() == 0 and none.columns[:3] == ["vec_id", "cluster", "distance"]


def test_ids_of_other_types(spark):
    rows = [(f"v{i}", v) for i, v in vectors(3, 30, 2, 0.2)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    assert found(df, k=4, rounds=2, dimensions=2) == plain(rows, 4, 2)


def test_too_large_numbers_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="would not fit a long"):
        centroids.cluster(df, dimensions=2)


def test_the_filter_verifies_few_points_and_misses_none():
    rng = np.random.default_rng(1)
    middles = rng.normal(0, 60, (40, 64))
    v = np.rint(middles[rng.integers(0, 40, 3000)] + rng.normal(0, 12, (3000, 64))).astype(np.int64)
    points = v[:40]
    mean = v.mean(axis=0)
    rotation = centroids.Rotation(mean, np.cov(v.T, bias=True))
    assert rotation.leading < 64
    number, distance, verified = centroids.nearest(v, rotation.short(v.astype(float)), points, rotation.short(points.astype(float)))
    every = ((v[:, None] - points[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert verified < 0.25 * every.size


def test_large_numbers_stay_exact():
    rng = np.random.default_rng(2)
    v = rng.integers(-centroids.LARGEST, centroids.LARGEST, (500, 64))
    v[250:] = v[:250] + rng.integers(-2, 3, (250, 64))
    points = v[:30]
    rotation = centroids.Rotation(v.mean(axis=0), np.cov(v.T.astype(float), bias=True))
    number, distance, _ = centroids.nearest(v, rotation.short(v.astype(float)), points, rotation.short(points.astype(float)))
    every = ((v[:, None] - points[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_extra_partitions_change_nothing(spark):
    rows = vectors(9, 120, 4, 0.3)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    one = found(df.coalesce(1), k=7, dimensions=4)
    assert one == found(df.repartition(9, F.lit(1)), k=7, dimensions=4) == plain(rows, 7, 5)
