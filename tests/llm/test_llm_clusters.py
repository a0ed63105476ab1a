"""Centroid clustering against plain integer arithmetic."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from sensorloom.llm import clusters, queries
from sensorloom.sources.tables import bucketed_table

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, count=8, rounds=10, dimension=64):
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v)
    ]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:count]]

    def nearest(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
        return min(range(len(far)), key=lambda i: (far[i], i)), min(far)

    for _ in range(rounds):
        groups = [[] for _ in centroids]
        for _, v in kept:
            groups[nearest(v)[0]].append(v)
        centroids = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(groups, centroids, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    sums = [sum(d for _, c, d in found if c == k) for k in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, sums[c], sum(sums), names[c]) for i, c, d in found), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    made = queries.op12_clusters(spark, sf_dir)
    assert [t for _, t in made.dtypes] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]
    assert result(made) == brute(rows)


def test_ties_repeats_and_odd_rows(spark):
    pick = random.Random(4)
    # Few different coordinates: many ties, equal vectors and empty clusters.
    rows = [(i % 70, [pick.choice([-1.0, 0.0, 1.0])] * 4) for i in range(150)]
    rows += [(None, [0.5, 0.25, -0.001, 1e-9]), (None, [0.5, 0.25, -0.001, 0.0]), (7, None), (8, []), (9, [1.0] * 5)]
    rows += [(10, [1.0, None, 1.0, 1.0]), (11, [float("nan"), 1.0, 1.0, 1.0]), (12, [1.0, 1.0, -math.inf, 1.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{VECTORS}, cluster int, block string").repartition(5)
    assert result(clusters.cluster(df, dimension=4)) == brute(rows, dimension=4)
    few = spark.createDataFrame(rows[:3], VECTORS)
    assert result(clusters.cluster(few, dimension=4)) == brute(rows[:3], dimension=4)
    assert result(clusters.cluster(few, dimension=4, count=1)) == brute(rows[:3], dimension=4, count=1)
    assert clusters.cluster(df.limit(0)).count() == 0 and clusters.cluster(df.where("size(embedding) = 5"), dimension=4).count() == 0


def test_values_that_fill_a_long(spark):
    rows = [(i, [131072.0 * (-1) ** (i // 2), 131072.0 - i, float(i)]) for i in range(12)]
    df = spark.createDataFrame(rows, VECTORS)
    assert result(clusters.cluster(df, dimension=3, count=3)) == brute(rows, dimension=3, count=3)
    with pytest.raises(Exception, match="would not fit a long"):
        clusters.cluster(spark.createDataFrame([(1, [131073.0])], VECTORS), dimension=1).collect()


def test_only_expired_gaps_are_scanned(spark):
    rng = np.random.default_rng(3)
    middle = rng.normal(0, 1, (8, 64))
    rows = [(i, (middle[i % 8] + rng.normal(0, 0.1, 64)).astype(np.float32).tolist()) for i in range(4000)]
    vectors = clusters.whole_vectors(spark.createDataFrame(rows, VECTORS).repartition(6), 64, key="vec_id", vector="embedding")
    made, _, scans = clusters.fit(vectors, count=8, rounds=10, dimension=64, scale=1024, seed="3")
    assert scans[0] == 4000 and sum(scans[-4:]) < 4000
    assert {r["key"]: r["cluster"] for r in made.collect()} == {i: c for i, c, *_ in brute(rows)}


def test_rounds_agree_with_whole_scans():
    """Bounds over many rounds of wandering centroids against scanning everything."""
    rng = np.random.default_rng(5)
    points = rng.integers(-2000, 2000, (500, 6)).astype(np.int32)
    state = (np.full(500, -1, np.int16), np.zeros(0), np.zeros(0, np.int32))
    now = clusters.Centroids(points[:7].astype(np.int64), np.zeros((7, 6), np.int64), np.zeros(7, np.int64), np.zeros(7))
    scanned = []
    for _ in range(25):
        *state, moved, n = clusters.rescanned(points, *state, now)
        scanned.append(n)
        far = np.stack([clusters.squared(points, c) for c in now.points], axis=1)
        assert (state[0] == far.argmin(axis=1)).all()
        assert sorted(state[2]) == list(range(500))
        for c in range(7):
            gaps = state[1][state[0][state[2]] == c]
            assert (np.diff(gaps) >= 0).all()
        now = now.updated(moved)
        assert now.counts.sum() == 500 and (now.sums.sum(axis=0) == points.sum(axis=0)).all()
    assert min(scanned) < 250


def test_vectors_are_not_shuffled_in_a_round(spark):
    """The blocks lie in their buckets; only heaps are dealt out."""
    rows = [(i, [float(i)] * 64) for i in range(50)]
    vectors = clusters.whole_vectors(spark.createDataFrame(rows, VECTORS), 64, key="vec_id", vector="embedding")
    blocks, drop = bucketed_table(clusters.packed(vectors, 1024), "block", 8, "vectors")
    now = clusters.Centroids(np.zeros((1, 64), np.int64), np.zeros((1, 64), np.int64), np.zeros(1, np.int64), np.zeros(1))
    state = clusters.written(clusters._round(blocks, None, now, 64), "heaps")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = clusters._round(blocks, state, now, 64)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    drop()
