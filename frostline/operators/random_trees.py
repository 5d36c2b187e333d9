"""Forests of extremely randomised trees: every column's cut is drawn at random, the best of a few columns is taken.

Readings become bins once, as for boosting. From a node's first and last bin of a column a cut is drawn uniformly between
the two values; counts on both sides follow from the same sums (`operators/forests.py`). Draws depend on seed, tree and
node only, and weights are summed as integers, so the same rows give the same forest in any order and partitioning.

All rows go to every tree (no bootstrap). Bagged forests grow the same way, from bootstrap samples and by the best cuts.
"""

import math
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from frostline.operators.boosting import binned, fit_edges, spread
from frostline.operators.forests import TASK_ROWS, Grown, Growth, grow_trees, random_splits, weight_unit
from frostline.operators.trees import Forest, Input
from frostline.workspace import fresh_path, remove

#: Nodes that are split in one turn; trees that grow side by side at most.
TURN_NODES, TOGETHER = 20_000, 500


@dataclass(frozen=True)
class RandomTrees:
    """Settings of a fit."""
    trees: int = 400
    depth: int = 30
    min_rows: int = 2  # in a leaf
    min_split: int = 2  # in a node that is split
    columns: str = "sqrt"  # how many columns with different values a node looks at: "sqrt", "log2" or "all"
    bins: int = 63
    seed: int = 42

    def copy(self, **changes) -> "RandomTrees":
        return replace(self, **changes)

    def tried(self, columns: int) -> int:
        return {"sqrt": max(1, math.isqrt(columns)), "log2": max(1, int(math.log2(columns))), "all": columns}[self.columns]


@dataclass(frozen=True)
class BaggedTrees:
    """Settings of a fit of a random forest: a bootstrap sample for each tree, the best cut of a few columns for each node."""
    trees: int = 20
    depth: int = 5
    min_rows: int = 1  # in a leaf
    min_split: int = 2  # in a node that is split
    columns: str = "auto"  # how many columns a node looks at: "sqrt", "log2", "onethird", "all"; "auto" goes by the target
    bins: int = 32
    seed: int = 42

    def copy(self, **changes) -> "BaggedTrees":
        return replace(self, **changes)

    def tried(self, columns: int, classify: bool) -> int:
        kind = ("sqrt" if classify else "onethird") if self.columns == "auto" else self.columns
        if self.trees == 1 and self.columns == "auto":
            kind = "all"
        return {"sqrt": math.ceil(math.sqrt(columns)), "log2": max(1, math.ceil(math.log2(columns))),
                "onethird": math.ceil(columns / 3.0), "all": columns}[kind]


def drawn_split(cells: np.ndarray, edges: list[list[float]], settings: RandomTrees, classes: int, rng: np.random.Generator) -> tuple[int, int] | None:
    """Column and last bin on the left of the best of a few columns' random cuts; None when no cut leaves enough rows.

    `cells` are one node's columns, bins, classes, weights and rows. A column's cut is drawn between the first edge that has
    rows below it and the last that has rows above. The best cut leaves the least Gini impurity, weighted.
    """
    wide, width = len(edges), max(len(e) for e in edges) + 1
    weights, rows = np.zeros((wide, width, classes)), np.zeros((wide, width))
    at = cells[:, :3].astype(np.int64)
    np.add.at(weights, tuple(at.T), cells[:, 3])
    np.add.at(rows, tuple(at.T[:2]), cells[:, 4])
    order = rng.permutation(wide)
    differ = (rows[order] > 0).sum(axis=1) > 1
    uniform = np.zeros(wide)
    uniform[differ] = rng.random(differ.sum())
    growth = _growth(settings, edges, classes, 1.0)
    place, cut, _ = random_splits(weights[None, order], rows[None, order], order[None], uniform[None], growth)
    return (int(order[place[0]]), int(cut[0])) if place[0] >= 0 else None


def _growth(settings: RandomTrees | BaggedTrees, edges: list[list[float]], classes: int, unit: float, gains: bool = False) -> Growth:
    bagged, wide = isinstance(settings, BaggedTrees), len(edges)
    return Growth(
        tuple(len(e) + 1 for e in edges), tuple(map(tuple, edges)), classes, settings.depth, settings.min_rows, settings.min_split,
        settings.tried(wide, classes > 0) if bagged else settings.tried(wide), bagged, not bagged, unit, settings.seed, gains)


def _fitted(df: DataFrame, inputs: list[Input], target: Column, weight: Column, classes: int, settings: RandomTrees | BaggedTrees,
            feature_set: str, gains: bool = False) -> tuple[list[Grown], list[list[float]], float]:
    """The trees (with the gains of all splits or the weights of all leaves), the edges of their inputs and the integers in
    one unit of weight."""
    if not 0 <= settings.depth <= 60:
        raise ValueError("A tree's depth must be between 0 and 60.")
    edges = fit_edges(df, inputs, feature_set, settings.bins)
    spark, path = df.sparkSession, fresh_path(df.sparkSession, "trees")
    # Equal rows are drawn apart from each other; the table is written once, so a draw stays with its row.
    draw = F.xxhash64(F.lit(settings.seed), F.monotonically_increasing_id())
    binned(df, inputs, feature_set, edges, (0.0,), target, weight, draw).write.parquet(path)
    held, trees, rows, unit = spark.read.parquet(path), [], None, 1.0
    try:
        n, largest = held.agg(F.coalesce(F.sum("n"), F.lit(0)), F.max("largest")).first()
        if not n and isinstance(settings, BaggedTrees):
            raise ValueError("There is no row to fit a random forest on.")
        if n:
            rows, tasks = spread(held, n, TASK_ROWS).persist(), 3 * spark.sparkContext.defaultParallelism
            unit = weight_unit(n, largest)
            growth = _growth(settings, edges, classes, unit, gains)
            for begin in range(0, settings.trees, TOGETHER):
                trees += grow_trees(rows, n, range(begin, min(begin + TOGETHER, settings.trees)), growth, TURN_NODES, tasks)
    finally:
        if rows:
            rows.unpersist()
        remove(spark, path)
    return trees, edges, unit


def _nodes(trees: list[Grown], edges: list[list[float]], inputs: list[Input], scores: int, weight: float, link: str, feature_set: str) -> Forest:
    first = np.cumsum([0, *(len(t.node) for t in trees)])
    shift = np.repeat(first[:-1], np.diff(first))
    joined = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
    column, cut = (joined([getattr(t, c) for t in trees], np.int64) for c in ("column", "cut"))
    left, right = (joined([t.children()[side] for t in trees], np.int64) + shift for side in (0, 1))
    held = np.concatenate([np.zeros((0, scores)), *(t.held for t in trees)])
    threshold = np.array([edges[c][b] if c >= 0 else 0.0 for c, b in zip(column, cut)])
    value = np.where(column[:, None] < 0, held, 0.0)
    return Forest(inputs, first, column, threshold, left, right, value, np.full(len(trees), weight), (0.0,) * scores, link, feature_set)


def random_trees(df: DataFrame, inputs: list[Input], label: str, classes: int, settings: RandomTrees | BaggedTrees, weight: str | None = None,
                 feature_set: str = "") -> Forest:
    """A forest whose scores are the sums of its trees' class shares. Rows without a label are left out."""
    df = df.where(F.col(label).isNotNull())
    heavy = F.col(weight).cast("double") if weight else F.lit(1.0)
    trees, edges, _ = _fitted(df, inputs, F.col(label).cast("double"), heavy, classes, settings, feature_set)
    for t in trees:
        t.held = t.held / np.maximum(t.held.sum(axis=1, keepdims=True), 1e-300)
    return _nodes(trees, edges, inputs, classes, 1.0, "votes", feature_set)


def bagged_numbers(df: DataFrame, inputs: list[Input], target: str, settings: BaggedTrees, feature_set: str = "") -> Forest:
    """A random forest whose score is the mean of its trees' means."""
    trees, edges, unit = _fitted(df, inputs, F.col(target).cast("double"), F.lit(1.0), 0, settings, feature_set)
    for t in trees:
        t.held = t.held / (np.maximum(t.n, 1.0)[:, None] * unit)
    return _nodes(trees, edges, inputs, 1, 1.0 / max(settings.trees, 1), "identity", feature_set)


def importances(df: DataFrame, columns: list[str], target: str, classes: int, settings: BaggedTrees) -> np.ndarray:
    """The share of each column in what the splits of a random forest take from the impurity: of each tree, then the mean of trees."""
    value = F.col(target).cast("double")
    trees, _, _ = _fitted(df, [Input(c) for c in columns], value, F.lit(1.0), classes, settings, "", gains=True)
    shares = np.zeros(len(columns))
    for t in trees:
        inner = t.column >= 0
        own = np.bincount(t.column[inner], t.gain[inner], len(columns))
        shares += own / own.sum() if own.sum() > 0 else 0.0
    return shares / shares.sum() if shares.sum() > 0 else shares
