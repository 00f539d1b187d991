"""Centroid clustering against plain Lloyd rounds in Python integers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from storelens.llm import centroids


def plain(rows, clusters, rounds, dims, scale=256, seed="2"):
    """rows of (id, vector) -> (id, cluster, distance, cluster_inertia, inertia, digest)."""
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    points = [v for _, v in first[:clusters]]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def nearest(v):
        return min((far(v, c), k) for k, c in enumerate(points))

    for _ in range(rounds):
        deal = [nearest(v)[1] for _, v in kept]
        new = []
        for k, old in enumerate(points):
            own = [v for (_, v), d in zip(kept, deal, strict=True) if d == k]
            new.append(tuple(sum(x) // len(own) for x in zip(*own, strict=True)) if own else old)
        points = new
    last = [nearest(v) for _, v in kept]
    return sorted(((i, k, d, sum(e for e, j in last if j == k), sum(e for e, _ in last),
                    hashlib.sha256(",".join(map(str, points[k])).encode()).hexdigest())
                   for (i, _), (d, k) in zip(kept, last, strict=True)), key=repr)


def lattice(n, dims, span, seed):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in rng.integers(-span, span + 1, dims) / 4]) for i in rng.permutation(n)]


@pytest.mark.parametrize(("n", "dims", "span", "clusters", "leaf"), [
    (300, 2, 3, 25, 1), (200, 3, 2, 40, 6), (150, 5, 9, 17, 2), (90, 1, 4, 30, 3)])
def test_equals_plain_rounds_with_many_ties(spark, monkeypatch, n, dims, span, clusters, leaf):
    monkeypatch.setattr(centroids, "LEAF", leaf)
    rows = lattice(n, dims, span, n)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)
    got = centroids.cluster_vectors(df, clusters=clusters, rounds=4, dims=dims)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, clusters, 4, dims)


def test_awkward_rows(spark):
    rows = lattice(40, 3, 5, 1) + [
        (None, [0.1, 0.2, 0.3]), (None, None), (5, None), (6, []), (7, [1.0, 2.0]), (8, [1.0, None, 2.0]),
        (9, [float("nan"), 0.0, 0.0]), (10, [float("inf"), 0.0, 0.0]), (11, [0.0, -0.0, -float("inf")]),
        (3, [0.5, 0.5, 0.5]), (3, [0.5, 0.5, 0.5]), (3, [-0.001, 0.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr(
        "*", "1 as cluster", "'x' as q", "2 as V", "'y' as CENTROID_SHA256")
    got = centroids.cluster_vectors(df, clusters=6, rounds=3, dims=3)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    want = plain(rows, 6, 3, 3)
    assert len(want) == 44 and sorted(map(tuple, got.collect()), key=repr) == want


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = lattice(4, 3, 5, 2)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = centroids.cluster_vectors(df, clusters=9, rounds=2, dims=3)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, 9, 2, 3)
    for nothing in (df.limit(0), df.selectExpr("vec_id", "cast(null as array<float>) as embedding")):
        none = centroids.cluster_vectors(nothing, dims=3)
        assert none.count() == 0 and none.columns == got.columns


def test_other_id_types_and_equal_vectors(spark):
    rows = [(f"v{i}", [1.0, 2.0]) for i in range(30)]
    df = spark.createDataFrame(rows, "name string, embedding array<float>")
    got = centroids.cluster_vectors(df, vec_id="name", clusters=5, dims=2).collect()
    assert {(r.cluster, r.distance) for r in got} == {(0, 0)} and {r.vec_id for r in got} == {r[0] for r in rows}


def test_large_components_are_exact_or_an_error(spark):
    rows = [(i, [float(i * 9_991), float(-i * 6_553)]) for i in range(60)]      # above exact doubles
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = centroids.cluster_vectors(df, clusters=7, rounds=3, dims=2)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, 7, 3, 2)
    with pytest.raises(Exception, match="don't fit|no exact"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [1e9, 0.0]), (2, [-1e9, 1.0])], df.schema), dims=2).collect()
    with pytest.raises(ValueError, match="are broadcast"):
        centroids.cluster_vectors(df, clusters=10**9, dims=2)


def test_the_tree_prunes_and_sees_ties():
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.integers(-50, 50, (30, 4)) + 1000 * k for k in range(8)])
    tree = centroids.VantageTree(points)
    opened = []
    original = tree._squared
    tree._squared = lambda rows, *rest: opened.append(len(rows) * len(rest[-1])) or original(rows, *rest)
    rows = rng.integers(-50, 8000, (500, 4))
    who, far = tree.nearest(rows)
    all_far = ((rows[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (who == all_far.argmin(axis=1)).all() and (far == all_far.min(axis=1)).all()
    assert sum(opened) < 0.5 * all_far.size
    assert tree.nearest(rows[:0])[0].tolist() == []
