"""Fitting models. A fitted model's predictions have no SQL; what must hold of them has: which rows they cover, and that
they stay in their range, add up, and beat the trivial answer. Those statements are columns, found from the predictions.
"""

from pyspark.sql import functions as F

from frostline.catalog.sql import ACTION, ID, RISK, r6, split_of, views
from frostline.fixtures import telemetry
from frostline.functions.numeric import rounded
from frostline.operators import training as ops
from frostline.operators.evaluation import regression_metrics
from frostline.operators.sampling import stratified_split
from frostline.operators.scoring import add_probabilities, predict_risk
from frostline.plans.classification import SHARES
from frostline.schema import CLASSES, PREDICTED_RISK, PROBABILITIES, SAFE, SENSORS, WATTS

# Watts are in thousands, so that products stay comparable.
_SCALE = {c: 1000.0 if c == WATTS else 1.0 for c in SENSORS}
# Rounds that two registered boosters grow, and shares of trees in the searches; forests, lines and the leaf-wise booster are
# fitted whole.
ROUNDS = {"depthwise": 30, "multiclass": 8}
HOLDOUT = {"train": 0.8, "test": 0.2}


def _parts(spark, sf_dir):
    """Training and test rows of the whole table."""
    rows, cores = telemetry(spark, sf_dir).drop("Event_Time"), spark.sparkContext.defaultParallelism
    if rows._jdf.rdd().getNumPartitions() < cores:  # few files, all the work of scoring in a few tasks
        rows = rows.repartition(cores)
    split = stratified_split(rows, ACTION, HOLDOUT)
    return tuple(split.where(F.col("split") == s).drop("split") for s in ("train", "test"))


def _products(fitted, value):
    """Means of `value` and of its products with every input."""
    wide = fitted.agg(F.avg(value).alias("one"), *[F.avg(F.col(value) * F.col(c) / _SCALE[c]).alias(c) for c in SENSORS])
    return wide.select(*[rounded(c, 4).alias(c) for c in ("one", *SENSORS)])


def _linear(spark, sf_dir):
    """The normal equations of the fitted line: predictions and readings have the same products with every input."""
    rows = telemetry(spark, sf_dir)
    return _products(ops.fit_regressor(rows, ops.legacy_regressors()["linear"]).transform(rows), "prediction")


def risk_rows(scored, *keep):
    """Each row with what holds of its predicted risk and of all of them."""
    beats = (regression_metrics(scored).first()["R2"] or 0.0) > 0.0
    return scored.select(ID, *keep, F.col(PREDICTED_RISK).between(0, 100).alias("bounded"), F.lit(beats).alias("beats_mean"))


def _regressor(name, legacy=True, rounds=None):
    def query(spark, sf_dir):
        train, test = _parts(spark, sf_dir)
        learner = (ops.legacy_regressors if legacy else ops.regressors)()[name]
        if rounds:
            learner = ops.changed(learner, {"rounds" if isinstance(learner, ops.Boosting) else "maxIter": rounds})
        return risk_rows(predict_risk(test, ops.fit_regressor(train, learner)), rounded(RISK).alias(RISK))
    return query


def _labelled(spark, sf_dir):
    train, test = _parts(spark, sf_dir)
    risk = ops.fit_regressor(train, ops.legacy_regressors()["linear"])
    return ops.prepare_labels(ops.add_predicted_risk(train, risk)), ops.add_predicted_risk(test, risk)


def _classifier(make):
    def query(spark, sf_dir):
        train, test = _labelled(spark, sf_dir)
        model = ops.fit_classifier(train, make())
        scored = ops.predict_label(add_probabilities(test, model), model)
        constant = ops.macro_f1(test.withColumn("Predicted_Class", F.lit(SAFE)))
        total = sum((F.col(p) for p in PROBABILITIES[1:]), F.col(PROBABILITIES[0]))
        inside = [F.col(p).between(0, 1) for p in PROBABILITIES]
        return scored.select(
            ID, ACTION, F.col("Predicted_Class").isin(CLASSES).alias("known"),
            ((F.abs(total - 1.0) < 1e-9) & inside[0] & inside[1] & inside[2]).alias("shares"),
            F.lit(ops.macro_f1(scored) > constant).alias("beats_constant"))
    return query


def _ranked(ranked, grid, n):
    """One row for each setting tried: drawn from the grid, scored, in order."""
    scores = [float(r["score"]) for r in ranked]
    drawn = [set(r["settings"]) == set(grid) and all(r["settings"][k] in grid[k] for k in grid) for r in ranked]
    different = len({str(sorted(r["settings"].items())) for r in ranked}) == n
    return [(i + 1, drawn[i], different, scores[i] <= 1.0 and (i == 0 or scores[i] <= scores[i - 1])) for i in range(len(ranked))]


_SEARCHED = "rank int, from_grid boolean, different boolean, ordered boolean"


def _search(spark, sf_dir):
    """Two draws, two folds, forests of a hundredth of the trees: a small stated job."""
    train, _ = _labelled(spark, sf_dir)
    _, ranked = ops.search_classifier(train, "random_forest", n_iter=2, folds=2, share=0.01)
    return spark.createDataFrame(_ranked(ranked, ops.shrink_grid(ops.CLASSIFIER_GRIDS["random_forest"], 0.01), 2), _SEARCHED)


def _search_regressor(spark, sf_dir):
    """Two draws, two folds, three to seven rounds."""
    train, _ = _parts(spark, sf_dir)
    _, ranked = ops.search_regressor(train, "boosted_leafwise", ACTION, n_iter=2, folds=2, share=0.01)
    return spark.createDataFrame(_ranked(ranked, ops.shrink_grid(ops.REGRESSOR_GRIDS["boosted_leafwise"], 0.01), 2), _SEARCHED)


def _select_best(spark, sf_dir):
    """A line and a forest of three trees on the holdout."""
    train, test = _parts(spark, sf_dir)
    learners = {n: ops.legacy_regressors(share=0.01)[n] for n in ("linear", "random_forest")}
    models = {n: ops.fit_regressor(train, e) for n, e in learners.items()}
    best, board = ops.select_best_regressor(models, test)
    rows = []
    for r in board:
        again = regression_metrics(predict_risk(test, models[r["Model"]])).first()
        same = all(abs(again[c] - r[c]) < 1e-9 for c in ("MAE", "RMSE", "R2"))
        rows.append((r["Model"], same, r["MAE"] <= r["RMSE"], board[0]["Model"] == best and board[0]["RMSE"] <= r["RMSE"], test.count()))
    return spark.createDataFrame(rows, "Model string, repeated boolean, mae_below_rmse boolean, best_is_lowest boolean, samples bigint")


def _refit(spark, sf_dir):
    """The products of training and validation readings, and whether those of the refit line's predictions agree."""
    rows = stratified_split(telemetry(spark, sf_dir).drop("Event_Time"), ACTION, SHARES)
    train, validation = (rows.where(F.col("split") == s).drop("split") for s in ("train", "validation"))
    model = ops.refit_production(ops.legacy_regressors()["linear"], train, validation)
    seen = model.transform(train.unionByName(validation))
    given, found = (_products(seen, value).first() for value in (RISK, "prediction"))
    agrees = all(abs(given[c] - found[c]) <= 1e-3 * (1.0 + abs(given[c])) for c in given.asDict())
    return _products(seen, RISK).withColumn("agrees", F.lit(agrees))


def _risk_feature(spark, sf_dir):
    """Both parts with the feature; the model that makes it has no true risk among its inputs."""
    train, test = _parts(spark, sf_dir)
    model = ops.fit_regressor(train, ops.legacy_regressors()["linear"])
    parts = [ops.add_predicted_risk(p.drop(RISK), model).withColumn("split", F.lit(s)) for s, p in (("train", train), ("test", test))]
    return parts[0].unionByName(parts[1]).select(ID, "split", F.col(PREDICTED_RISK).between(0, 100).alias("bounded"))


QUERIES = {
    "linear_regression": _linear,
    "forest_regression": _regressor("random_forest"),
    "boosted_regression_depthwise": _regressor("boosted_depthwise", rounds=ROUNDS["depthwise"]),
    "boosted_regression_leafwise": _regressor("boosted_leafwise", legacy=False),
    "logistic_regression": _classifier(lambda: ops.baseline_classifiers()["logistic"]),
    "decision_tree": _classifier(lambda: ops.baseline_classifiers()["decision_tree"]),
    "forest_classification": _classifier(lambda: ops.classifiers()["random_forest"]()),
    "forest_no_bootstrap": _classifier(lambda: ops.classifiers()["forest_no_bootstrap"]()),
    "boosted_multiclass": _classifier(lambda: ops.classifiers()["boosted"](rounds=ROUNDS["multiclass"])),
    "random_search": _search,
    "random_search_regression": _search_regressor,
    "select_best": _select_best,
    "refit_production": _refit,
    "risk_feature": _risk_feature,
}

_PRODUCTS = ", ".join(f"round(avg({RISK} * {c} / {_SCALE[c]}), 4) + 0e0 AS {c}" for c in SENSORS)
_HELD_OUT = views() + f", {split_of('telemetry', 'parts', ACTION, HOLDOUT)}"
_RISKS = _HELD_OUT + f" SELECT {ID}, {r6(RISK)} AS {RISK}, true AS bounded, true AS beats_mean FROM parts WHERE split = 'test'"
_LABELS = _HELD_OUT + f" SELECT {ID}, {ACTION}, true AS known, true AS shares, true AS beats_constant FROM parts WHERE split = 'test'"
_TRIED = "SELECT CAST(unnest([1, 2]) AS INTEGER) AS rank, true AS from_grid, true AS different, true AS ordered"

CHECKS = {
    "linear_regression": views() + f" SELECT round(avg({RISK}), 4) + 0e0 AS one, {_PRODUCTS} FROM telemetry",
    "forest_regression": _RISKS,
    "boosted_regression_depthwise": _RISKS,
    "boosted_regression_leafwise": _RISKS,
    "logistic_regression": _LABELS,
    "decision_tree": _LABELS,
    "forest_classification": _LABELS,
    "forest_no_bootstrap": _LABELS,
    "boosted_multiclass": _LABELS,
    "random_search": _TRIED,
    "random_search_regression": _TRIED,
    "select_best": _HELD_OUT + """, held AS (SELECT count(*) AS n FROM parts WHERE split = 'test')
        SELECT unnest(['linear', 'random_forest']) AS Model, true AS repeated, true AS mae_below_rmse, true AS best_is_lowest, n AS samples FROM held""",
    "refit_production": views() + f""", {split_of('telemetry', 'parts', ACTION, SHARES)}
        SELECT round(avg({RISK}), 4) + 0e0 AS one, {_PRODUCTS}, true AS agrees FROM parts WHERE split <> 'test'""",
    "risk_feature": _HELD_OUT + f" SELECT {ID}, split, true AS bounded FROM parts",
}
