"""Trees are the same wherever their nodes are split; bagged forests learn and repeat."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from frostline.operators import forests, training
from frostline.operators.forests import Growth, best_splits, copies, summed
from frostline.operators.random_trees import BaggedTrees, RandomTrees, bagged_numbers, importances, random_trees
from frostline.operators.trees import Input, raw_scores

INPUTS = [Input(c) for c in "abc"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 30, 900), rng.normal(size=900), rng.integers(0, 2, 900)]).astype(float)
    k = ((x[:, 0] > 12).astype(int) + (x[:, 1] > 0.5)) % 3
    y = 2.0 * x[:, 0] - 5.0 * x[:, 1] + rng.normal(size=900)
    return spark.createDataFrame([(*map(float, r), int(c), float(v)) for r, c, v in zip(x, k, y)], "a double, b double, c double, k int, y double").repartition(3).cache()


@pytest.mark.parametrize("settings", [RandomTrees(trees=3, depth=9), BaggedTrees(trees=3, depth=9, min_rows=2)])
def test_trees_are_the_same_wherever_nodes_are_split(table, monkeypatch, settings):
    whole = random_trees(table, INPUTS, "k", 3, settings)
    monkeypatch.setattr(forests, "LOCAL_ROWS", 60)  # the first levels are split by sums of all tasks
    monkeypatch.setattr(forests, "CELLS", 2_000)
    parts = random_trees(table, INPUTS, "k", 3, settings)
    for name in ("first", "input", "threshold", "left", "right", "value"):
        assert (getattr(whole, name) == getattr(parts, name)).all()


def test_bagged_numbers(table, monkeypatch):
    settings = BaggedTrees(trees=20, depth=8, min_rows=2, columns="all")
    forest = bagged_numbers(table, INPUTS, "y", settings)
    scored = raw_scores(table, forest, "s").select("y", F.get("s", F.lit(0)).alias("p")).toPandas()
    assert 1.0 - ((scored.y - scored.p) ** 2).mean() / scored.y.var() > 0.9
    monkeypatch.setattr(forests, "LOCAL_ROWS", 100)
    again = bagged_numbers(table, INPUTS, "y", settings)
    assert (again.threshold == forest.threshold).all() and (again.value == forest.value).all()
    found = importances(table.select("a", "b", "c", F.col("y").alias("label")), list("abc"), "label", 0, settings)
    assert found.sum() == pytest.approx(1.0) and found[0] > found[1] > found[2]
    with pytest.raises(ValueError):
        bagged_numbers(table.limit(0), INPUTS, "y", settings)


def test_best_cut_equals_brute_force():
    rng = np.random.default_rng(9)
    for trial in range(40):
        n, classes = 50, (0, 3)[trial % 2]
        bins, times = rng.integers(0, 6, (n, 3)), rng.integers(1, 4, n)
        label = rng.integers(0, 3, n) if classes else np.zeros(n, np.int64)
        weight = rng.integers(1, 40, n).astype(float)
        growth = Growth((6,) * 3, ((0.0,) * 5,) * 3, classes, 5, 1 + trial % 5, 2, 3, True, False, 1.0, 7)
        columns = np.array([[2, 0, 1]])
        place, cut, gain = best_splits(*summed(bins, label, weight, times, np.zeros(n, np.int64), columns, growth), columns, growth)

        def quality(s):
            sums = np.bincount(label[s], (weight * times)[s], 3)
            return (sums ** 2).sum() / (sums.sum() if classes else times[s].sum())

        tried = [(quality(left) + quality(~left) - quality(left | ~left), c, b) for c in range(3) for b in range(5)
                 for left in [bins[:, c] <= b] if min(times[left].sum(), times[~left].sum()) >= growth.min_rows]
        assert gain[0] == pytest.approx(max(tried)[0]) and (max(tried)[0], columns[0, place[0]], cut[0]) in [(pytest.approx(t[0]), *t[1:]) for t in tried]


def test_bootstrap_draws_with_replacement():
    growth = Growth((2,), ((0.0,),), 0, 1, 1, 2, 1, True, False, 1.0, 7)
    drawn = np.array([copies(np.arange(20_000), t, growth) for t in range(4)])
    assert drawn.mean() == pytest.approx(1.0, abs=0.03) and (drawn == 0).mean() == pytest.approx(np.exp(-1), abs=0.02)
    assert abs(np.corrcoef(drawn)[0, 1]) < 0.03


def test_gaps_are_an_error_as_before(spark, readings):
    from frostline.schema import WATTS
    broken = readings.withColumn(WATTS, F.when(F.rand(1) > 0.5, F.col(WATTS)))
    with pytest.raises(Exception, match="missing in a row"):
        training.fit_regressor(broken, training.legacy_regressors(share=0.01)["random_forest"])


def test_trees_share_the_passes_over_wide_nodes(table, monkeypatch):
    settings = BaggedTrees(trees=12, depth=6, min_rows=2)
    whole, passes, split = random_trees(table, INPUTS, "k", 3, settings), [], forests._split_wide
    monkeypatch.setattr(forests, "LOCAL_ROWS", 200)
    monkeypatch.setattr(forests, "PAIRS", 1_000)  # rows of about one tree are sent together
    monkeypatch.setattr(forests, "_split_wide", lambda *a: passes.append(len(a[1])) or split(*a))
    parts = random_trees(table, INPUTS, "k", 3, settings)
    assert passes[0] == 12 and len(passes) <= settings.depth
    assert (whole.threshold == parts.threshold).all() and (whole.value == parts.value).all()


def test_grown_parts_are_packed():
    rng = np.random.default_rng(4)
    bins, label, draw = rng.integers(0, 30, (4_000, 3)).astype(np.uint8), rng.integers(0, 3, 4_000), rng.integers(0, 1 << 60, 4_000)
    for gains in (False, True):
        growth = Growth((30,) * 3, ((0.0,) * 29,) * 3, 3, 30, 1, 2, 2, True, False, 8.0, 7, gains)
        made = forests.grown_here(bins, label, np.full(4_000, 8.0), copies(draw, 0, growth), 0, 5, growth)
        packed = forests._packed(made, growth)
        assert sum(map(len, packed)) < len(made[0]) * (9 if gains else 5)  # 44 bytes a node as plain numbers
        node, column, cut, gain, n, held = (x[np.argsort(made[0])] for x in made)
        found = forests._part(5, dict(zip(("col", "cut", "gain", "n", "held"), packed)), growth)
        inner = column >= 0
        assert (found[0] == node).all() and (found[1] == column).all() and (found[2][inner] == cut[inner]).all()
        assert (found[3][inner] == gain[inner]).all() if gains else (found[5][~inner] == held[~inner]).all()


def test_importance_makes_its_rows_once(spark, table):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(value):
        made.add(1)
        return value

    counted = counted.asNondeterministic()
    found = training.forest_importance(table.select(counted("a").alias("a"), "b", "c", "y"), list("abc"), "y", trees=3, depth=4).collect()
    assert {r["feature"] for r in found} == set("abc") and made.value == 900
