"""Centroid clustering: SQL twin, plain Lloyd rounds in Python integers, ties, few and odd vectors."""

import hashlib
import math
import random

import numpy as np
import oracle
import pytest

from seqloom.llm import centroids
from seqloom.llm.queries import QUERIES


def lloyd(rows, k, size, rounds):
    """rows of (id, vector) -> {place: (cluster, distance)}, centroids; all in Python integers."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in kept]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    at = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(at))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        at = [[sum(c) // len(groups[j]) for c in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(at)]
    return [(i, *nearest(v)[::-1]) for i, v in kept], at


def check(spark, rows, k, size, rounds, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id LONG, embedding ARRAY<{kind.upper()}>, _near STRING").repartition(3)
    got = centroids.cluster(frame, k=k, components=size, rounds=rounds).collect()
    plain = [(i, v if v is None or kind == "double" else [None if x is None else float(np.float32(x)) for x in v]) for i, v, _ in rows]
    want, at = lloyd(plain, k, size, rounds)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([(r["__rest"]["vec_id"], r["_near"], r["_distance"]) for r in got], key=key) == sorted(want, key=key)
    for r in got:
        assert r["_centroid"] == at[r["_near"]]
        assert r["_inertia"] == sum(d for *_, d in want)
        assert r["_cluster_inertia"] == sum(d for _, c, d in want if c == r["_near"])
        assert r["__rest"]["_near"] == "x"


def test_matches_sql(spark, sf):
    query = QUERIES["op12_centroid_clustering"]
    assert oracle.differences(query.run(spark, sf), oracle.connect(sf), query.sql) == []


@pytest.mark.parametrize(("k", "size", "rounds", "spread"), [(16, 4, 3, 1.0), (5, 2, 6, 0.06), (1, 3, 2, 1.0), (7, 1, 4, 0.03), (2, 3, 0, 1)])
def test_equals_lloyd(spark, k, size, rounds, spread):
    rng = random.Random(k)
    rows = [(i % 350, [rng.gauss(rng.choice([-1, 0, 1]), 0.3) * spread for _ in range(size)], "x") for i in range(400)]
    check(spark, rows + rows[:50], k, size, rounds)


def test_odd_vectors_are_left_out_and_few_give_few_centroids(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0], [1.0, 2.0, 3.0], [None, 1.0], [nan, 0.0], [inf, 0.0], [-inf, 1.0]]
    good = [[0.0, 0.0], [0.0, 0.0], [-0.01, 2e6], [-2e6, 5.5]]
    check(spark, [(i if i % 3 else None, v, "x") for i, v in enumerate(odd + good)], 16, 2, 3, "double")
    check(spark, [(i, v, "x") for i, v in enumerate(odd)], 16, 2, 3, "double")


def test_components_beyond_reach_raise(spark):
    with pytest.raises(Exception, match="would not fit a long"):
        check(spark, [(1, [3e6], "x"), (2, [1e300], "x")], 2, 1, 1, "double")


def test_search_skips_distances_and_stays_exact():
    rng = np.random.default_rng(5)
    means = rng.integers(-200, 200, (16, 8))
    x = (means[rng.integers(0, 16, 5000)] + rng.integers(-9, 10, (5000, 8))).astype(np.int64)
    now, known, computed = x[:16].copy(), centroids.Bounds.unknown(len(x), 16), []
    before = None
    for _ in range(6):
        computed.append(centroids.search(x, known, centroids.Centroids(now, before)))
        every = ((x[:, None, :] - now[None]) ** 2).sum(2)
        assert (known.near == every.argmin(1)).all()
        assert (known.upper**2 >= every.min(1) - 1e-6).all()
        others = np.where(np.arange(16) == known.near[:, None], np.iinfo(np.int64).max, every).min(1)
        assert (known.lower**2 <= others * (1 + 1e-9)).all()
        before = now
        now = np.array([x[known.near == j].sum(0) // max((known.near == j).sum(), 1) if (known.near == j).any() else now[j] for j in range(16)])
    assert computed[0] < 16 * len(x) and computed[-1] < 3 * len(x)
