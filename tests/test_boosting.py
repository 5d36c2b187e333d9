"""Best-first trees against brute force, rounds against their losses, and the same trees in any partitioning."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from frostline.operators import boosting, training
from frostline.operators.boosting import Boosting, Node, Tree, boosted_classes, boosted_numbers
from frostline.operators.scoring import add_probabilities
from frostline.operators.trees import Input, linked, raw_scores

EXACT = Boosting(rounds=3, learning_rate=0.3, leaves=12, min_rows=15, subsample=1.0, columns=1.0, kept_rounds=2)


@pytest.fixture(scope="module")
def table(spark):
    """2,000 rows whose columns have few values, so that every cut lies between two bins."""
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 30, 2000), rng.integers(-5, 6, 2000), rng.integers(0, 2, 2000) * 1.5, rng.integers(0, 40, 2000) / 8])
    y = x[:, 0] * (x[:, 1] > 0) + 3 * x[:, 2] - (x[:, 3] > 3) * 8 + rng.normal(size=2000).round(2)
    k = (y > 6).astype(int) + (y > 14)
    rows = [(*map(float, r), float(v), int(c), float(1 + (c == 2))) for r, v, c in zip(x, y, k)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y double, k int, w double").repartition(5).cache()


INPUTS = [Input(c) for c in "abcd"]


def plain_tree(x, g, h, leaves, min_rows):
    """Best-first growth over all cuts of all columns: (rows, column, largest value on the left, gain) of each split."""
    def best(rows):
        found, whole = None, g[rows].sum() ** 2 / h[rows].sum()
        for c in range(x.shape[1]):
            for cut in np.unique(x[rows, c])[:-1]:
                low = rows[x[rows, c] <= cut]
                high = rows[x[rows, c] > cut]
                if min(len(low), len(high)) >= min_rows:
                    gain = g[low].sum() ** 2 / h[low].sum() + g[high].sum() ** 2 / h[high].sum() - whole
                    if found is None or gain > found[0] + 1e-9:
                        found = (gain, c, cut, low, high)
        return found

    open_leaves, splits = [best(np.arange(len(x)))], []
    while len(splits) < leaves - 1:
        at = max((i for i, s in enumerate(open_leaves) if s), key=lambda i: open_leaves[i][0], default=None)
        if at is None:
            break
        gain, c, cut, low, high = open_leaves.pop(at)
        splits.append((len(low) + len(high), c, float(cut), gain))
        open_leaves += [best(low), best(high)]
    return splits


def splits_of(forest, tree: Tree, number):
    out = []
    for at in tree.accepted:
        node = tree.nodes[at]
        out.append((int(node.rows[0].sum()), node.split[1], float(forest.threshold[forest.first[number] + at]), node.split[0]))
    return out


def test_every_split_equals_brute_force(spark, table):
    forest, rounds = boosted_numbers(table.select(*"abcd", "y"), INPUTS, "y", EXACT)
    data = np.array(table.select(*"abcd", "y").collect())
    x, y = data[:, :4], data[:, 4]
    scores = np.full(len(y), y.mean())
    for number, (tree,) in enumerate(rounds):
        plain = plain_tree(x, scores - y, np.ones(len(y)), EXACT.leaves, EXACT.min_rows)
        found = splits_of(forest, tree, number)
        assert len(found) == len(plain) == EXACT.leaves - 1
        for (n, c, cut, gain), (rows, column, low, best) in zip(found, plain):
            assert (n, c) == (rows, column) and gain == pytest.approx(best, rel=1e-6)
            between = x[:, c][x[:, c] > low].min()
            assert low <= cut < between  # the same rows on the left
        scores = forest_scores(forest, x, number + 1)[:, 0]
    assert ((scores - y) ** 2).mean() < y.var() / 3


def forest_scores(forest, x, trees):
    """Scores from the first trees alone."""
    whole = forest.weight.copy()
    whole[trees:] = 0.0
    return type(forest)(**{**forest.__dict__, "weight": whole}).walk(x)


def log_loss(scores, k, w):
    share = np.exp(scores - scores.max(axis=1, keepdims=True))
    share /= share.sum(axis=1, keepdims=True)
    return -(w * np.log(share[np.arange(len(k)), k])).sum() / w.sum()


def test_softmax_splits_and_losses(spark, table):
    settings = EXACT.copy(rounds=6)
    forest, rounds = boosted_classes(table.select(*"abcd", "k", "w"), INPUTS, "k", 3, settings, "w")
    data = np.array(table.select(*"abcd", "k", "w").collect())
    x, k, w = data[:, :4], data[:, 4].astype(int), data[:, 5]
    losses = [log_loss(forest_scores(forest, x, 3 * r), k, w) for r in range(7)]
    assert all(b < a for a, b in zip(losses, losses[1:]))
    scores = forest_scores(forest, x, 0)
    share = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
    for c in range(3):
        plain = plain_tree(x, w * (share[:, c] - (k == c)), w * share[:, c] * (1 - share[:, c]), settings.leaves, settings.min_rows)
        found = splits_of(forest, rounds[0][c], c)
        assert [(n, column) for n, column, _, _ in found] == [(n, column) for n, column, _, _ in plain]
        assert [gain for *_, gain in found] == pytest.approx([gain for *_, gain in plain], rel=1e-6)
    sums = raw_scores(table, forest, "s").select(F.aggregate(linked(F.col("s"), "softmax"), F.lit(0.0), lambda a, p: a + p).alias("t"))
    assert sums.where("abs(t - 1) > 1e-12").count() == 0


def test_softmax_is_below_one_booster_for_each_class(labelled_rows):
    rows, inputs = labelled_rows
    settings = Boosting(rounds=6, learning_rate=0.3, leaves=31, min_rows=5, subsample=1.0, columns=1.0)
    forest, _ = boosted_classes(rows, inputs, "label", 3, settings, "weight", "classification")
    each = training.fit_classifier(rows, training.BoostedOneVsRest(maxIter=6, stepSize=0.3, maxDepth=5, weightCol="weight", seed=42))

    def loss(model):
        scored = add_probabilities(rows, model, ["0", "1", "2"])
        chosen = F.get(F.array("Probability_0", "Probability_1", "Probability_2"), F.col("label").cast("int"))
        return scored.agg(F.sum(-F.col("weight") * F.ln(F.greatest(chosen, F.lit(1e-15)))) / F.sum("weight")).first()[0]

    assert loss(forest) < loss(each)


@pytest.fixture(scope="module")
def labelled_rows(readings):
    rows = training.prepare_labels(readings.withColumn("Predicted_Spoilage_Risk_Pct", F.col("Forecasted_4Hr_Spoilage_Risk_Pct") * 0 + 20.0))
    inputs = [Input(c) for c in training.CLASSIFICATION_COLUMNS if c != "Predicted_Spoilage_Risk_Pct"]
    return rows.cache(), inputs


def test_same_trees_in_any_order_and_after_every_write(table):
    settings = EXACT.copy(subsample=0.7, columns=0.5)
    found = [boosted_numbers(t.select(*"abcd", "y"), INPUTS, "y", s)[0] for t, s in (
        (table, settings), (table.repartition(3, "b"), settings), (table.orderBy("y").coalesce(1), settings.copy(kept_rounds=1)))]
    for other in found[1:]:
        assert (other.threshold == found[0].threshold).all() and (other.input == found[0].input).all()
        assert (other.value == found[0].value).all()


def test_odd_tables(spark, table):
    settings = EXACT.copy(rounds=2)
    nothing, rounds = boosted_numbers(table.limit(0).select(*"abcd", "y"), INPUTS, "y", settings)
    assert rounds == [] and nothing.trees == 0 and nothing.walk(np.zeros((2, 4))).tolist() == [[0.0], [0.0]]
    constant, rounds = boosted_numbers(table.select(*"abcd", F.lit(4.0).alias("y")), INPUTS, "y", settings)
    assert rounds == [] and raw_scores(table, constant, "s").first()["s"] == [4.0]
    gaps = table.select(F.when(F.col("b") > 2, F.col("a")).alias("a"), "b", F.lit(None).cast("double").alias("c"), "d", F.when(F.col("d") < 4, F.col("y")).alias("y"))
    forest, rounds = boosted_numbers(gaps, INPUTS, "y", settings)
    assert len(rounds) == 2 and int(rounds[0][0].nodes[0].rows[0].sum()) == gaps.where("y IS NOT NULL").count()
    one, rounds = boosted_classes(table.where("k = 1").select(*"abcd", "k"), INPUTS, "k", 3, settings)
    assert rounds == [] and linked_first(table, one) == pytest.approx([0.0, 1.0, 0.0], abs=1e-9)


def linked_first(table, forest):
    return raw_scores(table, forest, "s").select(linked(F.col("s"), forest.link).alias("p")).first()["p"]


def test_growth_waits_for_unknown_sums():
    tree = Tree([Node(split=(5.0, 0, 1), left=1, right=2), Node(split=(1.0, 0, 0)), Node(split=(4.0, 1, 0), left=3, right=4), Node(), Node(split=(2.0, 0, 3))])
    assert tree.advance(3) == [] and tree.accepted == [0, 2]
    assert tree.advance(4) == [4] and tree.accepted == [0, 2]
    assert tree.advance(9) == [4, 1] and tree.depth() == 2
    kept = Tree(tree.nodes, [0]).kept()
    assert [(n.left, n.right) for n in kept.nodes] == [(1, 2), (-1, -1), (-1, -1)] and kept.accepted == [0]
    assert math.isclose(kept.nodes[0].split[0], 5.0)


def test_the_driver_gets_one_short_row_for_a_leaf(table, monkeypatch):
    """Sums by column and bin stay in tasks, and meet in several of them: the same trees, and no cells at the driver."""
    settings = Boosting(rounds=2, leaves=8, min_rows=5, subsample=1.0, columns=1.0, bins=31)
    _, whole = boosted_numbers(table, INPUTS, "y", settings)
    edges, gathered, kind = boosting.fit_edges(table, INPUTS, "", settings.bins), [], type(table)
    monkeypatch.setattr(boosting, "fit_edges", lambda *_: edges)
    monkeypatch.setattr(boosting, "_TASK_LEAVES", 2)
    for name in ("collect", "toArrow"):
        plain = getattr(kind, name)
        monkeypatch.setattr(kind, name, lambda df, plain=plain: gathered.append(plain(df)) or gathered[-1])
    _, rounds = boosted_numbers(table, INPUTS, "y", settings)
    tried = sum(len(t.nodes) for r in rounds for t in r)
    assert tried == 2 * 15 and sum(len(g) for g in gathered) <= 3 * tried
    assert [[n.split for n in t.nodes] for r in rounds for t in r] == [[n.split for n in t.nodes] for r in whole for t in r]


@pytest.mark.parametrize("classes", [0, 3])
def test_one_task_grows_the_same_rounds(table, monkeypatch, classes):
    settings = EXACT.copy(rounds=5, subsample=0.7, columns=0.5)
    columns = [*"abcd", "k", "w"] if classes else [*"abcd", "y"]
    asked, splits = [], boosting._splits
    monkeypatch.setattr(boosting, "_splits", lambda *a: asked.append(1) or splits(*a))
    found = []
    for rows in (2000, 1999):  # in one task, and by jobs for each round
        monkeypatch.setattr(boosting, "LOCAL_ROWS", rows)
        made = boosted_classes(table.select(columns), INPUTS, "k", 3, settings, "w") if classes else boosted_numbers(table.select(columns), INPUTS, "y", settings)
        found.append((made, len(asked)))
    (here, first), (spread, last) = found
    assert first == 0 and last >= 5
    for name in ("first", "input", "threshold", "left", "right", "value"):
        assert (getattr(here[0], name) == getattr(spread[0], name)).all()
    assert [[t.accepted for t in r] for r in here[1]] == [[t.accepted for t in r] for r in spread[1]]
    assert [[(n.split, int(n.rows[0, 0])) for n in t.nodes] for r in here[1] for t in r] == [[(n.split, int(n.rows[0, 0])) for n in t.nodes] for r in spread[1] for t in r]


def test_the_registered_fit_grows_all_rounds(spark, monkeypatch, readings):
    """700 rounds of the regression run, none left out: the settings reach the fit as they are."""
    from frostline.catalog import training as catalog

    asked = []
    monkeypatch.setattr(catalog.ops, "fit_regressor", lambda rows, learner: asked.append(learner))
    monkeypatch.setattr(catalog, "_parts", lambda *_: (readings, readings))
    monkeypatch.setattr(catalog, "predict_risk", lambda rows, _: rows)
    monkeypatch.setattr(catalog, "risk_rows", lambda rows, *_: rows)
    catalog.QUERIES["boosted_regression_leafwise"](spark, "")
    assert asked == [training.regressors()["boosted_leafwise"]] and asked[0].rounds == 700
