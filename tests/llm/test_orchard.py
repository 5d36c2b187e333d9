"""Clustering: Orchard's search against all distances, rounds against plain Python, odd vectors."""

import hashlib
import math

import numpy as np
import pytest

from frostline.llm import orchard

SCHEMA = "vec_id bigint, embedding array<double>"


@pytest.mark.parametrize("spread, k, dims", [(2, 30, 2), (3, 40, 3), (1000, 25, 8), (1 << 26, 12, 64), (1, 7, 1), (5, 1, 4)])
def test_search_equals_all_distances_with_ties(spread, k, dims):
    rng = np.random.default_rng(spread)
    centroids = rng.integers(-spread, spread + 1, (k, dims))
    vectors = np.concatenate([rng.integers(-spread, spread + 1, (5000, dims)), centroids])
    cluster, distance = orchard.Orchard(centroids).nearest(vectors)
    every = ((vectors[:, None] - centroids) ** 2).sum(2)
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert [len(x) for x in orchard.Orchard(centroids).nearest(vectors[:0])] == [0, 0]


def test_search_stops_early(monkeypatch):
    rng = np.random.default_rng(1)
    centroids = np.cumsum(rng.integers(50, 100, (200, 2)), axis=0)  # far apart on a line
    vectors = centroids[rng.integers(0, 200, 300)] + 1
    tree, seen = orchard.Orchard(centroids), []
    plain = np.zeros
    monkeypatch.setattr(orchard.np, "zeros", lambda shape, dtype=float: seen.append(plain(shape, dtype)) or seen[-1])
    tree.nearest(vectors)
    visited = next(x for x in seen if x.dtype == bool)
    assert visited.mean() < 0.7


def plainly(rows, k, rounds, dims, salt="2:"):
    held = [(i, [math.floor(256 * x) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    hashed = sorted((hashlib.sha256(f"{salt}{'' if i is None else i}".encode()).hexdigest(), x) for i, x in held)
    centroids = [x for _, x in hashed[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        mine = [(nearest(x)[1], x) for _, x in held]
        for n in range(len(centroids)):
            members = [x for c, x in mine if c == n]
            if members:
                centroids[n] = [sum(c) // len(members) for c in zip(*members)]
    return [(i, *nearest(x)[::-1]) for i, x in held], centroids


def test_rounds_equal_plain_python(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(v) for v in rng.integers(-3, 4, 3) / 256 + rng.choice([0, 0.7 / 256])]) for i in range(400)]
    rows += [(1, rows[1][1]), (2, rows[2][1]), (None, [0.1, 0.2, 0.3]), (500, None), (501, []), (502, [1.0, 2.0]), (503, [1.0, None, 2.0]),
             (504, [1.0, float("nan"), 2.0]), (505, [float("-inf"), 1.0, 2.0]), (506, [1.0, 2.0, 3.0, 4.0])]
    table = spark.createDataFrame([(i, e, 9, 8) for i, e in rows], SCHEMA + ", cluster int, x int").repartition(5)
    found, centroids = orchard.clustered(table, k=12, rounds=3, dims=3)
    expected, ends = plainly(rows, 12, 3, 3)
    assert centroids.tolist() == ends
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([tuple(r) for r in found.collect()], key=key) == sorted(expected, key=key)


def test_few_none_and_too_large_vectors(spark):
    two = spark.createDataFrame([(1, [0.5, 0.5]), (2, [1.0, 2.0])], SCHEMA)
    found, centroids = orchard.clustered(two, k=40, dims=2)
    assert len(centroids) == 2 and sorted(r.distance for r in found.collect()) == [0, 0]
    for table in (two.limit(0), spark.createDataFrame([(1, None), (2, [1.0])], SCHEMA)):
        found, centroids = orchard.clustered(table, dims=2)
        assert found.count() == 0 and len(centroids) == 0
    names = spark.createDataFrame([("a", [1.0, 1.0]), ("b", [5.0, 5.0])], "vec_id string, embedding array<float>")
    assert {r.vec_id for r in orchard.clustered(names, k=1, dims=2)[0].collect()} == {"a", "b"}
    with pytest.raises(Exception, match="64 bits"):
        orchard.clustered(spark.createDataFrame([(1, [1e30, 0.0])], SCHEMA), dims=2)
