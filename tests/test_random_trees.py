"""Random cuts against brute force, repeatable forests, and quality."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from frostline.operators import random_trees as ops, training
from frostline.operators.random_trees import RandomTrees, drawn_split, random_trees
from frostline.operators.trees import Input, linked, raw_scores

INPUTS = [Input(c) for c in "abc"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.integers(0, 20, 800), rng.integers(-4, 5, 800), rng.integers(0, 2, 800)]).astype(float)
    k = ((x[:, 0] > 12).astype(int) + ((x[:, 0] > 5) & (x[:, 1] > 1)) + (rng.random(800) < 0.05)) % 3
    return spark.createDataFrame([(*map(float, r), int(c), float(1 + c)) for r, c in zip(x, k)], "a double, b double, c double, k int, w double").repartition(4).cache()


def test_best_of_the_drawn_cuts_equals_brute_force():
    rng = np.random.default_rng(5)
    for trial in range(60):
        n, edges = 60, [list(np.sort(rng.normal(size=6))) for _ in range(4)]
        bins, label, weight = rng.integers(0, 7, (n, 4)), rng.integers(0, 3, n), rng.integers(1, 5, n)
        if trial % 3 == 0:
            bins[:, 1] = 2  # a constant column doesn't count as tried
        cells = np.array([(c, b, k, weight[(bins[:, c] == b) & (label == k)].sum(), ((bins[:, c] == b) & (label == k)).sum())
                          for c in range(4) for b in range(7) for k in range(3) if ((bins[:, c] == b) & (label == k)).any()])
        settings = RandomTrees(min_rows=1 + trial % 4, columns="all" if trial % 2 else "sqrt")
        found = drawn_split(cells, edges, settings, 3, np.random.default_rng([trial]))
        again, best, tried = np.random.default_rng([trial]), None, 0
        for c in again.permutation(4):
            low, high = bins[:, c].min(), bins[:, c].max()
            if low == high:
                continue
            draw = again.uniform(edges[c][low], edges[c][high - 1])
            cut = sum(e <= draw for e in edges[c]) - 1
            left = bins[:, c] <= cut
            assert low <= cut < high
            tried += 1
            if min(left.sum(), (~left).sum()) >= settings.min_rows:
                score = sum(sum(weight[s & (label == k)].sum() ** 2 for k in range(3)) / weight[s].sum() for s in (left, ~left))
                if best is None or score > best[0] + 1e-9:
                    best = (score, c, cut)
            if tried >= settings.tried(4) and best:
                break
        assert found == (best[1:] if best else None)


def test_leaves_hold_the_rows_that_reach_them(table):
    settings = RandomTrees(trees=3, depth=6, min_rows=5, min_split=20)
    forest = random_trees(table, INPUTS, "k", 3, settings, "w")
    data = np.array(table.select("a", "b", "c", "k", "w").collect())
    for t in range(3):
        own = slice(forest.first[t], forest.first[t + 1])
        node, depth = np.full(len(data), forest.first[t]), 0
        while (forest.input[node] >= 0).any():
            asked = np.maximum(forest.input[node], 0)
            lower = data[np.arange(len(data)), asked] <= forest.threshold[node]
            counts = np.bincount(node[forest.input[node] >= 0], minlength=len(forest.input))
            assert counts[counts > 0].min() >= settings.min_split
            node, depth = np.where(lower, forest.left[node], forest.right[node]), depth + 1
        assert depth <= settings.depth and np.bincount(node)[np.unique(node)].min() >= settings.min_rows
        for leaf in np.unique(node):
            mine = data[node == leaf]
            weights = np.array([mine[mine[:, 3] == k, 4].sum() for k in range(3)])
            assert forest.value[leaf] == pytest.approx(weights / weights.sum(), abs=1e-6)
        assert set(np.flatnonzero(forest.input[own] < 0) + forest.first[t]) == set(np.unique(node))


def test_cuts_repeat_by_seed_in_any_partitioning(table, monkeypatch):
    settings = RandomTrees(trees=3, min_rows=2, depth=8)
    found = [random_trees(t, INPUTS, "k", 3, s) for t, s in (
        (table, settings), (table.orderBy("b").coalesce(1), settings), (table, settings.copy(seed=7)))]
    assert (found[0].threshold == found[1].threshold).all() and (found[0].value == found[1].value).all()
    assert len(found[0].input) != len(found[2].input) or (found[0].threshold != found[2].threshold).any()
    monkeypatch.setattr(ops, "TURN_NODES", 30)
    monkeypatch.setattr(ops, "TOGETHER", 2)
    turned = random_trees(table, INPUTS, "k", 3, settings)
    assert turned.trees == 3 and (np.diff(turned.first) > 1).all()
    assert (turned.threshold == found[0].threshold).all()


def test_forest_learns_and_odd_tables(spark, table):
    forest = random_trees(table, INPUTS, "k", 3, RandomTrees(trees=20))
    scored = raw_scores(table, forest, "s")
    right = scored.where(F.array_position("s", F.array_max("s")) - 1 == F.col("k")).count()
    assert right > 0.85 * table.count()
    total = scored.select(F.aggregate(linked(F.col("s"), "votes"), F.lit(0.0), lambda a, p: a + p).alias("t"))
    assert total.where("abs(t - 1) > 1e-9").count() == 0
    assert random_trees(table.limit(0), INPUTS, "k", 3, RandomTrees(trees=2)).trees == 0
    one = random_trees(table.where("k = 1").select("a", "b", F.lit(None).cast("double").alias("c"), "k"), INPUTS, "k", 3, RandomTrees(trees=2))
    assert one.input.tolist() == [-1, -1] and one.value[0].tolist() == [0.0, 1.0, 0.0]
    learner = training.changed(RandomTrees(), {"numTrees": 7, "maxDepth": 3, "minInstancesPerNode": 4, "min_split": 9})
    assert (learner.trees, learner.depth, learner.min_rows, learner.min_split) == (7, 3, 4, 9)
