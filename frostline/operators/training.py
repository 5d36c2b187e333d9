"""Fitting regressors and action classifiers: MLlib's learners and boosting of this library."""

import itertools
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from frostline.functions import features as feature_functions
from frostline.functions.features import CLASSIFICATION, REGRESSION
from frostline.operators.boosting import Boosting, boosted_classes, boosted_numbers
from frostline.operators.encoding import fit_labels, label_encode
from frostline.operators.evaluation import (
    balanced_weights, confusion_counts, holdout_metrics, interval_half_width, regression_metrics, weighted_metrics,
)
from frostline.operators.logistic import SoftmaxRegression
from frostline.operators.random_trees import BaggedTrees, RandomTrees, bagged_numbers, importances, random_trees
from frostline.operators.sampling import stratified_split
from frostline.operators.scoring import predict_risk
from frostline.operators.trees import Forest, Input, raw_scores
from frostline.schema import ACTION, CARGO, CLASSES, ID, INPUTS, PREDICTED_RISK, RISK, SENSORS
from frostline.workspace import enable_checkpoints

REGRESSION_COLUMNS = [*SENSORS, *REGRESSION]
CLASSIFICATION_COLUMNS = [*SENSORS, *CLASSIFICATION, PREDICTED_RISK]


class FeatureBuilder(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A feature set as a pipeline stage, so a saved model derives its own features."""

    featureSet = Param(Params._dummy(), "featureSet", "regression, classification, staged or legacy",
                       typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, featureSet="regression"):
        super().__init__()
        self._setDefault(featureSet="regression")
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        return getattr(feature_functions, f"features_{self.getOrDefault(self.featureSet)}")(dataset)


class NormalizedVotes(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Class probabilities from one binary probability column per class, divided by their sum."""

    columns = Param(Params._dummy(), "columns", "binary probability columns, in label order",
                    typeConverter=TypeConverters.toListString)
    working = Param(Params._dummy(), "working", "columns to drop", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, columns=None, working=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        votes = [vector_to_array(F.col(c))[1] for c in self.getOrDefault(self.columns)]
        marked = dataset.withColumn("_votes", F.array(*votes))
        total = F.aggregate("_votes", F.lit(0.0), lambda a, v: a + v)
        shares = F.transform("_votes", lambda v: v / F.col("_total"))
        best = F.array_position("_votes", F.array_max("_votes")) - 1
        return (
            marked.withColumn("_total", total)
            .withColumns({"probability": array_to_vector(shares), "prediction": best.cast("double")})
            .drop("_votes", "_total", *self.getOrDefault(self.working))
        )


class BoostedOneVsRest(Estimator):
    """Boosted trees for several classes: one binary booster per class, normalised."""

    def __init__(self, classes: int = len(CLASSES), **booster):
        super().__init__()
        self.classes = classes
        self.booster = booster

    def _fit(self, dataset):
        stages, votes, working = [], [], []
        for k in range(self.classes):
            marked = dataset.withColumn("_is", F.when(F.col("label") == k, 1.0).otherwise(0.0))
            learner = GBTClassifier(featuresCol="features", labelCol="_is", predictionCol=f"_pred{k}", **self.booster)
            learner.setProbabilityCol(f"_prob{k}").setRawPredictionCol(f"_raw{k}")
            stages.append(learner.fit(marked))
            votes.append(f"_prob{k}")
            working += [f"_pred{k}", f"_prob{k}", f"_raw{k}"]
        return PipelineModel([*stages, NormalizedVotes(columns=votes, working=working)])


def preparation(columns: list[str], feature_set: str | None) -> list:
    """Stages from raw readings to the scaled `features` vector; unseen cargo gives all zeros."""
    stages = [FeatureBuilder(featureSet=feature_set)] if feature_set else []
    return stages + [
        StringIndexer(inputCol=CARGO, outputCol="_cargo_code", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="_cargo_code", outputCol="_cargo", dropLast=True),
        VectorAssembler(inputCols=columns, outputCol="_raw_numbers"),
        StandardScaler(inputCol="_raw_numbers", outputCol="_numbers", withMean=True, withStd=True),
        VectorAssembler(inputCols=["_numbers", "_cargo"], outputCol="features"),
    ]


def make_pipeline(estimator: Estimator, columns: list[str], feature_set: str | None) -> Pipeline:
    return Pipeline(stages=[*preparation(columns, feature_set), estimator])


def _trees(n: int, share: float) -> int:
    return max(2, round(n * share))


def _learner(cls, seed: int, **params):
    """A tree learner that truncates its lineage on long fits."""
    return cls(seed=seed, checkpointInterval=10, **params)


# Fixed values below: the learners' settings. Depth 30, MLlib's deepest, stands for "no limit".

#: What a search or a run can fit: MLlib's learners, or settings of this library's.
Learner = Estimator | Boosting | RandomTrees | BaggedTrees
#: Names of the same settings in grids and of this library's forests.
_TREE_NAMES = {"numTrees": "trees", "maxDepth": "depth", "minInstancesPerNode": "min_rows", "featureSubsetStrategy": "columns"}
Model = PipelineModel | Forest


def regressors(seed: int = 42, share: float = 1.0) -> dict[str, Learner]:
    """Candidates of the regression run; `share` shrinks the number of trees for trials."""
    return {
        "boosted_leafwise": Boosting(rounds=_trees(700, share), learning_rate=0.03, leaves=31, subsample=0.8, columns=0.9, seed=seed),
        "boosted_depthwise": _learner(GBTRegressor, seed, maxIter=_trees(500, share), stepSize=0.03, maxDepth=5,
                                      subsamplingRate=0.8, featureSubsetStrategy="0.9", labelCol=RISK),
        "random_forest": BaggedTrees(trees=_trees(400, share), depth=16, min_rows=2, columns="all", seed=seed),
    }


def legacy_regressors(seed: int = 42, share: float = 1.0) -> dict[str, Learner]:
    """The older single-model settings."""
    return {
        "linear": LinearRegression(labelCol=RISK),
        "random_forest": BaggedTrees(trees=_trees(300, share), depth=10, min_rows=4, columns="all", seed=seed),
        "boosted_depthwise": _learner(GBTRegressor, seed, maxIter=_trees(300, share), stepSize=0.03, maxDepth=4,
                                      subsamplingRate=0.7, labelCol=RISK),
        "boosted_leafwise": Boosting(rounds=_trees(700, share), learning_rate=0.01, leaves=31, subsample=0.8, columns=1.0, seed=seed),
    }


def risk_regressor(seed: int = 42, share: float = 1.0) -> Learner:
    return Boosting(rounds=_trees(500, share), learning_rate=0.03, leaves=31, subsample=0.8, columns=0.9, seed=seed)


def classifiers(seed: int = 42, share: float = 1.0) -> dict[str, Callable[..., Learner]]:
    """Candidates of the classification run as builders, so that a search can change their settings."""
    def boosted(**changes):
        return Boosting(rounds=_trees(500, share), learning_rate=0.03, leaves=31, subsample=0.8, columns=0.9, seed=seed).copy(**changes)

    def forest(**changes):
        return changed(BaggedTrees(trees=_trees(400, share), depth=30, min_rows=2, columns="sqrt", seed=seed), changes)

    def random_cuts(**changes):
        return changed(RandomTrees(trees=_trees(400, share), min_rows=2, seed=seed), changes)

    return {"boosted": boosted, "random_forest": forest, "forest_no_bootstrap": random_cuts}


def baseline_classifiers(seed: int = 42, share: float = 1.0) -> dict[str, Learner]:
    """The staged run's first models."""
    return {
        "logistic": SoftmaxRegression(maxIter=1000, labelCol="label"),
        "decision_tree": _learner(DecisionTreeClassifier, seed, maxDepth=30, labelCol="label"),
        "random_forest": BaggedTrees(trees=_trees(300, share), depth=30, seed=seed),
        "forest_no_bootstrap": RandomTrees(trees=_trees(300, share), min_rows=1, seed=seed),
    }


CLASSIFIER_GRIDS = {
    "boosted": {"rounds": [300, 500, 700], "learning_rate": [0.03, 0.05, 0.08], "leaves": [31, 50, 80],
                "subsample": [0.8, 0.9, 1.0], "columns": [0.8, 0.9, 1.0]},
    "random_forest": {"numTrees": [300, 400, 500], "maxDepth": [10, 15, 20, 30], "minInstancesPerNode": [1, 2, 4]},
    "forest_no_bootstrap": {"numTrees": [300, 400, 500], "maxDepth": [10, 15, 20, 30], "minInstancesPerNode": [1, 2, 4],
                            "min_split": [2, 5, 10]},
}
STAGED_GRID = {"numTrees": [200, 300, 500], "maxDepth": [10, 20, 30], "minInstancesPerNode": [1, 2, 4],
               "featureSubsetStrategy": ["sqrt", "log2"]}
REGRESSOR_GRIDS = {
    "random_forest": {"numTrees": [200, 300, 500, 700], "maxDepth": [8, 10, 15, 20, 30], "minInstancesPerNode": [1, 2, 4]},
    "boosted_depthwise": {"maxIter": [300, 500, 700], "stepSize": [0.01, 0.03, 0.05, 0.1], "maxDepth": [4, 6, 8, 10],
                          "subsamplingRate": [0.7, 0.8, 0.9, 1.0], "featureSubsetStrategy": ["0.7", "0.8", "0.9", "all"]},
    "boosted_leafwise": {"rounds": [300, 500, 700], "learning_rate": [0.01, 0.03, 0.05, 0.1], "leaves": [31, 50, 80, 120],
                         "subsample": [0.7, 0.8, 0.9, 1.0], "columns": [0.7, 0.8, 0.9, 1.0]},
}


def shrink_grid(grid: dict[str, list], share: float) -> dict[str, list]:
    """The grid with fewer trees, for trials."""
    return {k: [_trees(v, share) for v in vs] if k in ("numTrees", "maxIter", "rounds") else vs for k, vs in grid.items()}


def prepare_labels(df: DataFrame, classes: list[str] = CLASSES) -> DataFrame:
    """Add the alphabetical `label` and the balanced `weight`."""
    encoded = label_encode(df, ACTION, classes, "label").withColumn("label", F.col("label").cast("double"))
    return balanced_weights(encoded, ACTION, classes)


def fit(estimator: Estimator, df: DataFrame, columns: list[str], feature_set: str | None) -> PipelineModel:
    enable_checkpoints(df.sparkSession)
    return make_pipeline(estimator, columns, feature_set).fit(df)


def changed(learner: Learner, settings: dict) -> Learner:
    """The learner with other settings."""
    if isinstance(learner, Estimator):
        return learner.copy({learner.getParam(k): v for k, v in settings.items()})
    return learner.copy(**{_TREE_NAMES.get(k, k) if isinstance(learner, RandomTrees | BaggedTrees) else k: v for k, v in settings.items()})


def _inputs(df: DataFrame, columns: list[str]) -> list[Input]:
    """Numbers as they are, and one input for each cargo of the rows."""
    return [Input(c) for c in columns] + [Input(CARGO, label) for label in fit_labels(df, CARGO) or []]


def without_gaps(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows; a null or NaN in these number columns is an error when it is read."""
    def held(c):
        gap = F.concat(F.lit(f"{c} is missing in a row to fit on: "), F.coalesce(F.col(c).cast("string"), F.lit("null")))
        return F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), F.raise_error(gap).cast("double")).otherwise(F.col(c))

    return df.withColumns({c: held(c) for c in columns})


def fit_regressor(df: DataFrame, learner: Learner) -> Model:
    rows = df.select(*INPUTS, RISK)
    if isinstance(learner, Boosting):
        return boosted_numbers(rows, _inputs(rows, REGRESSION_COLUMNS), RISK, learner, "regression")[0]
    if isinstance(learner, BaggedTrees):
        rows = without_gaps(rows, [*SENSORS, RISK])
        return bagged_numbers(rows, _inputs(rows, REGRESSION_COLUMNS), RISK, learner, "regression")
    return fit(learner, rows, REGRESSION_COLUMNS, "regression")


def fit_classifier(df: DataFrame, learner: Learner) -> Model:
    """Needs `Predicted_Spoilage_Risk_Pct`, `label` and `weight`; the true risk is not passed on."""
    rows = df.select(*INPUTS, PREDICTED_RISK, "label", "weight")
    if isinstance(learner, Boosting):
        return boosted_classes(rows, _inputs(rows, CLASSIFICATION_COLUMNS), "label", len(CLASSES), learner, "weight", "classification")[0]
    if isinstance(learner, BaggedTrees):
        rows = without_gaps(rows, [*SENSORS, PREDICTED_RISK, "label", "weight"])
    if isinstance(learner, RandomTrees | BaggedTrees):
        return random_trees(rows, _inputs(rows, CLASSIFICATION_COLUMNS), "label", len(CLASSES), learner, "weight", "classification")
    return fit(learner, rows, CLASSIFICATION_COLUMNS, "classification")


def predict_label(df: DataFrame, model: Model, classes: list[str] = CLASSES) -> DataFrame:
    """Add the most probable class as `Predicted_Class`."""
    if isinstance(model, Forest):
        scored = raw_scores(df, model, "_s").withColumn("prediction", F.array_position("_s", F.array_max("_s")) - 1)
    else:
        scored = model.transform(df)
    return scored.select(*df.columns, F.get(F.lit(classes), F.col("prediction").cast("int")).alias("Predicted_Class"))


def add_predicted_risk(df: DataFrame, model: Model) -> DataFrame:
    """Risk predicted from operating inputs only, as a classifier feature."""
    return predict_risk(df, model)


# ---------------------------------------------------------------- scores

def macro_f1(df: DataFrame, classes: list[str] = CLASSES) -> float:
    return holdout_metrics(confusion_counts(df, classes=classes), 0.0).first()["macro_f1_observed_classes"] or 0.0


def weighted_f1(df: DataFrame, classes: list[str] = CLASSES) -> float:
    return weighted_metrics(confusion_counts(df, classes=classes)).first()["F1_Score"]


def r2(df: DataFrame) -> float:
    return regression_metrics(df).first()["R2"]


# ---------------------------------------------------------------- search and selection

def draw_settings(grid: dict[str, list], n: int, seed: int) -> list[dict]:
    """n different settings of a grid, in a repeatable order; all of them when there are fewer."""
    names = sorted(grid)
    every = list(itertools.product(*[grid[k] for k in names]))
    chosen = random.Random(seed).sample(every, min(n, len(every)))
    return [dict(zip(names, values)) for values in chosen]


def random_search(df: DataFrame, fit_one: Callable[[dict, DataFrame], Model],
                  score: Callable[[Model, DataFrame], float], grid: dict[str, list], by: str,
                  n_iter: int = 20, folds: int = 3, seed: int = 42, key: str = ID,
                  parallelism: int = 2) -> tuple[dict, list[dict]]:
    """Mean cross-validated score of randomly drawn settings; best first.

    Folds are equal shares of every class. Fits run side by side from driver threads, each
    over the whole cluster.
    """
    shares = {str(k): 1.0 / folds for k in range(folds)}
    folded = stratified_split(df, by, shares, seed, key).withColumnRenamed("split", "fold").persist()
    settings = draw_settings(grid, n_iter, seed)

    def one(task):
        number, fold = task
        model = fit_one(settings[number], folded.where(F.col("fold") != str(fold)).drop("fold"))
        return number, score(model, folded.where(F.col("fold") == str(fold)).drop("fold"))

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            results = list(pool.map(one, itertools.product(range(len(settings)), range(folds))))
    finally:
        folded.unpersist()
    means = [
        {"settings": s, "score": sum(v for n, v in results if n == i) / folds} for i, s in enumerate(settings)]
    ranked = sorted(means, key=lambda m: -m["score"])
    return ranked[0]["settings"], ranked


def search_classifier(df: DataFrame, name: str, n_iter: int = 20, folds: int = 3, seed: int = 42, share: float = 1.0,
                      parallelism: int = 2) -> tuple[dict, list[dict]]:
    """Random search of one candidate on macro F1."""
    build = classifiers(seed, share)[name]
    return random_search(
        df, lambda s, part: fit_classifier(part, build(**s)), lambda m, part: macro_f1(predict_label(part, m)),
        shrink_grid(CLASSIFIER_GRIDS[name], share), ACTION, n_iter, folds, seed, parallelism=parallelism)


def search_regressor(df: DataFrame, name: str, strata: str, n_iter: int = 20, folds: int = 5, seed: int = 42,
                     share: float = 1.0, parallelism: int = 2) -> tuple[dict, list[dict]]:
    """Random search of one regressor on R2; folds keep the shares of the `strata` column."""
    base = regressors(seed, share)[name]
    return random_search(
        df, lambda s, part: fit_regressor(part, changed(base, s)), lambda m, part: r2(predict_risk(part, m)), shrink_grid(REGRESSOR_GRIDS[name], share), strata,
        n_iter, folds, seed, parallelism=parallelism)


def select_best_regressor(models: dict[str, Model], validation: DataFrame) -> tuple[str, list[dict]]:
    """Validation metrics of every model, lowest RMSE first."""
    rows = []
    for name, model in models.items():
        metrics = regression_metrics(predict_risk(validation, model)).first().asDict()
        rows.append({"Model": name, **metrics})
    rows.sort(key=lambda r: (r["RMSE"], r["Model"]))
    return rows[0]["Model"], rows


def refit_production(estimator: Learner, train: DataFrame, validation: DataFrame) -> Model:
    """Fit the chosen regressor on training and validation rows together."""
    columns = [*INPUTS, RISK]
    return fit_regressor(train.select(columns).unionByName(validation.select(columns)), estimator)


def half_width_of(model: Model, validation: DataFrame, q: float = 0.90) -> float:
    return interval_half_width(predict_risk(validation, model), q=q).first()["half_width"]


# ---------------------------------------------------------------- importance

def _labelled_numbers(df: DataFrame, columns: list[str], target: str, classify: bool) -> tuple[DataFrame, int]:
    """Rows without gaps, as numbers, with the target as `label`; and the number of classes, 0 for a number."""
    rows, classes = df.na.drop(subset=[*columns, target]), 0
    if classify:
        rows = label_encode(rows, target, output="_label")
        classes = int(rows.agg(F.max("_label")).first()[0] or 0) + 1
    else:
        rows = rows.withColumn("_label", F.col(target))
    return rows.select(*[F.col(c).cast("double").alias(c) for c in columns], F.col("_label").cast("double").alias("label")), classes


def forest_importance(df: DataFrame, columns: list[str], target: str = ACTION, trees: int = 200, depth: int = 10,
                      seed: int = 42) -> DataFrame:
    """Impurity importance of each column, largest first; a text target is classified, a number regressed."""
    classify = dict(df.dtypes)[target] == "string"
    # kept as they are, or the test for gaps repeats what the columns are made from, too long to be compiled, in every scan
    read = df.select(*dict.fromkeys([*columns, target])).persist()
    try:
        rows, classes = _labelled_numbers(read, columns, target, classify)
        scores = [float(v) for v in importances(rows, columns, "label", classes, BaggedTrees(trees, depth, seed=seed))]
    finally:
        read.unpersist()
    return df.sparkSession.createDataFrame(list(zip(columns, scores)), "feature string, importance double") \
        .orderBy(F.desc("importance"), "feature")


def recursive_feature_elimination(df: DataFrame, columns: list[str], target: str = RISK, k: int = 8, trees: int = 100,
                                  depth: int = 10, seed: int = 42) -> DataFrame:
    """Drop the least important column until k are left; rank 1 is kept, higher ranks went earlier."""
    classify = dict(df.dtypes)[target] == "string"
    left, gone = list(columns), []
    read = df.select(*dict.fromkeys([*columns, target])).persist()
    try:
        rows, classes = _labelled_numbers(read, columns, target, classify)
        while len(left) > k:
            importance = importances(rows.select(*left, "label"), left, "label", classes, BaggedTrees(trees, depth, seed=seed))
            weakest = min(range(len(left)), key=lambda i: (importance[i], left[i]))
            gone.append(left.pop(weakest))
    finally:
        read.unpersist()
    ranked = [(c, True, 1) for c in left] + [(c, False, i + 2) for i, c in enumerate(reversed(gone))]
    return df.sparkSession.createDataFrame(ranked, "feature string, selected boolean, ranking int").orderBy("ranking", "feature")

