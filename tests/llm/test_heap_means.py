"""Clustering by heaps against a plain version, and what the bounds save."""

import hashlib
import math

import numpy as np
import pytest

from ledgerloom.llm import heap_means


def plain(rows, k, rounds, width, scale=256):
    """Assignments and centroids by comparing all vectors with all centroids, in Python integers."""
    kept = [(i, [max(-(1 << 27), min(1 << 27, math.floor(scale * x))) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [v for _, v in start]

    def assigned():
        far = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids] for _, v in kept]
        return [(min(range(len(f)), key=lambda j: (f[j], j)), min(f)) for f in far]

    for _ in range(rounds):
        found = assigned()
        for j in range(len(centroids)):
            mine = [v for (_, v), (c, _) in zip(kept, found, strict=True) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = assigned()
    inertia = [sum(d for c, d in found if c == j) for j in range(len(centroids))]
    told = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia), told[c]) for (i, _), (c, d) in zip(kept, found, strict=True)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("rounds", [0, 1, 6])
def test_as_plain(spark, rounds):
    rng = np.random.default_rng(rounds)
    points = rng.normal(size=(400, 6)) + rng.integers(0, 3, size=(400, 1)) * 2
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # one vector, many times
    rows += [(7, rows[7][1]), (None, rows[9][1]), (None, None), (2000, []), (2001, [1.0] * 5), (2002, [1.0] * 5 + [None]), (2003, [1.0] * 5 + [math.nan]), (2004, [1.0] * 5 + [-math.inf])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    for k in (1, 7):
        assert got(heap_means.clustered(df, k=k, rounds=rounds, width=6)) == plain(rows, k, rounds, 6)


def test_large_values_are_exact_and_held(spark):
    rows = [(i, [float(i % 5) * 5e4 + i, -3e5 + i * 1000.0]) for i in range(60)] + [(90, [1e30, 0.0]), (91, [-1e300, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(heap_means.clustered(df, k=5, rounds=3, width=2)) == plain(rows, 5, 3, 2)


def test_few_vectors_ties_and_empty(spark):
    schema = "vec_id string, embedding array<float>, cluster int, block int"
    rows = [("a", [0.0]), ("b", [2.0]), ("c", [1.0]), ("c", [1.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], schema)
    assert got(heap_means.clustered(df, k=40, rounds=4, width=1)) == plain(rows, 40, 4, 1)
    empty = heap_means.clustered(df.limit(0), width=1)
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_only_expired_gaps_are_compared(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(3000, 8)) * 0.2 + rng.integers(0, 10, size=(3000, 1)) * 3
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    compared = []
    heap_means.clustered(df, k=10, rounds=8, width=8, report=compared).count()
    assert compared[0] == 3000 and compared[-1] < 1500


def test_heaps_survive_packing_and_pop_in_order():
    heaps = heap_means.Heaps([[], []])
    heaps.push(np.arange(6), np.array([0, 0, 1, 0, 1, 0]), np.array([5.0, 1.0, 2.0, 3.0, 0.5, 4.0]))
    again = heap_means.Heaps.unpacked(*heaps.packed())
    rows, of = again.popped(np.array([3.0, 1.0]), 0.0)
    assert rows.tolist() == [1, 3, 4] and of.tolist() == [0, 0, 1]
    assert again.clusters(6)[[0, 2, 5]].tolist() == [0, 1, 0]


def test_no_exchange_of_vectors_between_rounds(spark):
    """Blocks and heaps are bucketed alike, so their join has no exchange."""
    tables = heap_means._Bucketed(spark, 4)
    one, two = (tables.stored(spark.range(50).withColumnRenamed("id", "block").repartition(4, "block"), n) for n in ("one", "two"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = one.join(two, "block")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        tables.drop("one")
        tables.drop("two")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
