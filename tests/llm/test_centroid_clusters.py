from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketspark.llm import centroid_clusters as cc

SCHEMA = "vec_id long, embedding array<float>"


def kept(vector, size=64):
    return vector is not None and len(vector) == size and all(x is not None and math.isfinite(x) for x in vector)


def brute(rows, clusters, rounds, size=64):
    points = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if kept(v, size)]
    order = sorted(points, key=lambda p: (p[0] is None, hashlib.sha256(f"1:{p[0]}".encode()).hexdigest()))
    centroids = [x for _, x in order[:clusters]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(centroids)) for _, x in points]

    for _ in range(rounds):
        place = assigned()
        for k in range(len(centroids)):
            if own := [x for (_, x), (_, c) in zip(points, place, strict=True) if c == k]:
                centroids[k] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    place = assigned()
    sums = [sum(d for d, c in place if c == k) for k in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, sums[c], sum(sums), digests[c]) for (i, _), (d, c) in zip(points, place, strict=True)), key=repr)


def found(df):
    return sorted((tuple(row) for row in df.drop("centroid").collect()), key=repr)


def vectors(seed, n=300, size=64):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(size)] for _ in range(9)]
    return [(i, [x + rng.gauss(0, 0.08) for x in centres[i % 9]]) for i in range(n)]


@pytest.mark.parametrize(("clusters", "rounds", "size"), [(16, 3, 64), (5, 0, 64), (7, 2, 8), (3, 1, 1)])
def test_clusters_equal_brute_force(spark, clusters, rounds, size):
    rows = vectors(clusters, size=size)
    result = cc.cluster_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5), clusters, rounds, size)
    assert found(result) == brute(rows, clusters, rounds, size)


def test_ties_repeated_rows_and_empty_centroids(spark):
    same = [0.5, -0.25] * 32
    rows = [(i, same) for i in range(30)] + vectors(2, 40)[30:] + [(7, same)] * 3
    result = cc.cluster_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert found(result) == brute(rows, 16, 3)


def test_vectors_that_cannot_be_kept(spark):
    good = vectors(3, 20)
    odd = [(100, None), (101, []), (102, [0.1] * 63), (103, [0.1] * 65), (104, [0.1] * 63 + [None]),
           (105, [0.1] * 63 + [float("nan")]), (106, [float("inf")] + [0.1] * 63), (107, [-float("inf")] * 64)]
    beyond = [(108, [1e30] + [0.0] * 63)]
    result = cc.cluster_vectors(spark.createDataFrame(good + odd + beyond, SCHEMA).withColumn("cluster", F.lit("x")), 4)
    assert found(result) == brute(good, 4, 3)


def test_large_components_stay_exact(spark):
    rng = random.Random(8)
    edge = (cc.LARGEST_COEFFICIENT // 64 - 64) / 64
    rows = [(i, [rng.choice([-edge, edge]) for _ in range(64)]) for i in range(12)]
    assert found(cc.cluster_vectors(spark.createDataFrame(rows, SCHEMA), 3)) == brute(rows, 3, 3)


def test_null_ids_few_vectors_and_empty_tables(spark):
    rows = [(None, [0.5] * 64), (1, [0.25] * 64)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert found(cc.cluster_vectors(table)) == brute(rows, 16, 3)
    assert cc.cluster_vectors(table.limit(0)).collect() == []
    assert cc.cluster_vectors(table.limit(0)).columns == cc.cluster_vectors(table).columns


def test_progressive_search_ends_at_the_nearest():
    rng = np.random.default_rng(4)
    x, centroids = rng.integers(-9, 9, (500, 64)), rng.integers(-9, 9, (33, 64))
    centroids[20] = centroids[3]
    x[:50] = centroids[rng.integers(0, 33, 50)]
    whole = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    best, distance = cc.nearest(cc.spectrum(x), cc.spectrum(centroids))
    assert (best == whole.argmin(axis=1)).all() and (distance == whole.min(axis=1)).all()
    assert (cc.components_of(cc.spectrum(x).astype(object)) == x).all()
    assert cc.coarse_first(64)[0] == 0


@pytest.mark.parametrize("options", [{"size": 48}, {"size": 0}, {"clusters": 0}, {"clusters": 1 << 20}])
def test_bounds_are_checked(spark, options):
    with pytest.raises(ValueError):
        cc.cluster_vectors(spark.createDataFrame([], SCHEMA), **options)
