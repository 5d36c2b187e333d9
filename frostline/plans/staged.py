"""The thirteen table-to-table stages, and the older balancing run."""

from collections.abc import Mapping

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from frostline.functions.features import STAGED, features_staged
from frostline.operators.contracts import apply_feature_selection, class_counts, filter_class, require_columns, require_finite
from frostline.operators.encoding import fit_labels, label_encode
from frostline.operators.evaluation import (
    best_model, classification_report, comparison_summary, confusion_counts, confusion_matrix, model_leaderboard, weighted_metrics,
)
from frostline.operators.profiling import (
    class_distribution, class_mean_comparison, classwise_statistics, dataset_overview, eda_summary, iqr_outliers,
    mutual_information, numerical_statistics, pearson_matrix, spearman_matrix,
)
from frostline.operators.random_trees import BaggedTrees, RandomTrees, random_trees
from frostline.operators.sampling import sample_with_replacement, split_report, stratified_split
from frostline.operators.selection import consensus_select, correlation_filter, require_selection, selection_report, vif_scores
from frostline.operators.synthesis import balance_classes, next_ids, scenario_bands
from frostline.operators.training import (
    STAGED_GRID, baseline_classifiers, changed, forest_importance, predict_label, prepare_labels, random_search,
    shrink_grid, weighted_f1, without_gaps,
)
from frostline.operators.trees import Forest, Input
from frostline.plans.classification import SHARES, TARGETS
from frostline.plans.resume import Stages
from frostline.schema import ACTION, CARGO, CLASSES, ID, INPUTS, NUMERIC, ORIGIN, RISK, WARNING
from frostline.sources.models import load_model, save_model
from frostline.sources.tables import load_feature_list, write_report, write_table
from frostline.workspace import enable_checkpoints


#: The stages of `run_staged` in their order.
STAGE_NAMES = ("split", "profile", "synthetic", "features", "selection", "validation_features", "test_features",
               "validation_selected", "test_selected", "baseline", "tuned", "comparison", "evaluation")


def run_staged(df: DataFrame, out: str, seed: int = 42, targets: Mapping[str, int] = TARGETS, share: float = 1.0,
               n_iter: int = 20, folds: int = 5, tuned: tuple[str, ...] = ("random_forest", "forest_no_bootstrap"),
               parallelism: int = 2, resume: bool = False) -> DataFrame:
    """Each stage reads and writes tables below `out`; returns the model leaderboard with the test row.

    The true risk is a known leak and is never selected. Derived features are computed after
    the synthetic rows are made, so they always agree with the raw readings. With `resume`, stages that an earlier run
    below `out` finished with the same inputs and settings are taken over (`plans/resume.py`).
    """
    spark = df.sparkSession
    columns = [ID, *INPUTS, RISK, ACTION]
    require_columns(df, columns)
    df = df.select(columns)
    stages = Stages(spark, out, resume, input=df)
    read = lambda table: spark.read.parquet(f"{out}/{table}")
    part = lambda name: read("processed").where(F.col("split") == name).drop("split")

    def split():
        write_table(stratified_split(df, ACTION, SHARES, seed), f"{out}/processed", ["split"])
        write_report(split_report(read("processed")), f"{out}/split_report")

    def profile():
        train = part("train")
        correlations = pearson_matrix(train, NUMERIC)
        for name, table in {
            "dataset_overview": dataset_overview(train), "class_distribution": class_distribution(train),
            "numerical_statistics": numerical_statistics(train), "classwise_statistics": classwise_statistics(train),
            "pearson": correlations, "spearman": spearman_matrix(train), "safe_warning_comparison": class_mean_comparison(train),
            "outliers": iqr_outliers(train), "mutual_information": mutual_information(train, NUMERIC),
        }.items():
            write_report(table, f"{out}/profile/{name}")
        importance = forest_importance(train, NUMERIC, trees=max(2, round(200 * share)), seed=seed)
        write_report(eda_summary(importance, correlations), f"{out}/profile/summary")

    def synthetic():
        write_table(balance_classes(part("train"), targets, "staged", seed), f"{out}/balanced_train")

    def features():
        write_table(features_staged(read("balanced_train")), f"{out}/engineered_train")

    def selection():
        engineered = require_finite(read("engineered_train"), list(STAGED))
        numbers = [c for c in [*NUMERIC, *STAGED] if c != RISK]
        cargos = fit_labels(engineered, CARGO)  # codes come from the training rows only
        coded = label_encode(engineered, CARGO, cargos, "Cargo_Code")
        candidates = ["Cargo_Code", *numbers]
        dropped = correlation_filter(coded, candidates)
        information = mutual_information(coded, candidates)
        forest = forest_importance(coded, candidates, trees=max(2, round(300 * share)), seed=seed)
        gone = {r["feature"] for r in dropped.collect()}
        write_report(vif_scores(coded, [c for c in candidates if c not in gone]), f"{out}/selection/vif")
        selected = consensus_select(information, forest, dropped)
        require_selection(selected)
        write_report(selection_report(selected), f"{out}/selection/features")
        names = [r["feature"] for r in load_feature_list(spark, f"{out}/selection/features").collect()]
        write_table(apply_feature_selection(coded, [ID, ORIGIN, *names]), f"{out}/selected/train")
        return {"features": names, "cargos": cargos}

    stages.run("split", split, ["input"], {"seed": seed, "shares": SHARES}, ["processed"], ["split_report"])
    stages.run("profile", profile, ["split"], {"seed": seed, "share": share}, files=["profile/summary"])
    stages.run("synthetic", synthetic, ["split"], {"seed": seed, "targets": dict(targets)}, ["balanced_train"])
    stages.run("features", features, ["synthetic"], {}, ["engineered_train"])
    chosen = stages.run("selection", selection, ["features"], {"seed": seed, "share": share}, ["selected/train"],
                        ["selection/vif", "selection/features"])
    names, cargos = chosen["features"], chosen["cargos"]

    # The same features and columns of validation and test
    for name in ("validation", "test"):
        def derived(name=name):
            write_table(features_staged(part(name)), f"{out}/engineered_{name}")

        stages.run(f"{name}_features", derived, ["split"], {}, [f"engineered_{name}"])
    for name in ("validation", "test"):
        def picked(name=name):
            rows = label_encode(read(f"engineered_{name}"), CARGO, cargos, "Cargo_Code")
            write_table(apply_feature_selection(rows, [ID, *names]), f"{out}/selected/{name}")

        stages.run(f"{name}_selected", picked, [f"{name}_features", "selection"], {}, [f"selected/{name}"])
    tables = {name: read(f"selected/{name}") for name in ("train", "validation", "test")}
    labelled = prepare_labels(tables["train"]).persist()
    learners = baseline_classifiers(seed, share)

    def fit_selected(estimator, rows):
        return fit_numbers(estimator, rows, names)

    def baseline():
        save_model(spark, f"{out}/models/Baseline", {}, **{n: fit_selected(e, labelled) for n, e in learners.items()})

    def search():
        fitted, tried = {}, []
        for name in tuned:
            learner = learners[name]
            best, ranked = random_search(
                labelled, lambda s, rows, learner=learner: fit_selected(changed(learner, s), rows),
                lambda m, rows: weighted_f1(predict_label(rows, m)), shrink_grid(STAGED_GRID, share), ACTION,
                n_iter, folds, seed, parallelism=parallelism)
            tried += [(name, i + 1, str(r["settings"]), float(r["score"])) for i, r in enumerate(ranked)]
            fitted[name] = fit_selected(changed(learner, best), labelled)
        save_model(spark, f"{out}/models/Tuned", {}, **fitted)
        write_report(spark.createDataFrame(tried, "Model string, rank int, settings string, weighted_f1 double"), f"{out}/search")

    try:
        stages.run("baseline", baseline, ["selection"], {"seed": seed, "share": share}, files=["models/Baseline/metadata"])
        stages.run("tuned", search, ["selection"], {"seed": seed, "share": share, "n_iter": n_iter, "folds": folds, "tuned": list(tuned)},
                   files=["models/Tuned/metadata", "search"])
    finally:
        labelled.unpersist()

    def scored(category):
        models = load_model(spark, f"{out}/models/{category}")[0]
        parts = [
            weighted_metrics(confusion_counts(predict_label(tables["validation"], m))).select(F.lit(n).alias("Model"), "*")
            for n, m in models.items()]
        return spark.createDataFrame([r for p in parts for r in p.collect()], parts[0].schema)

    def comparison():
        board = model_leaderboard(scored("Baseline"), scored("Tuned"))
        write_table(board, f"{out}/comparison/leaderboard_table")
        board = read("comparison/leaderboard_table")
        write_report(board, f"{out}/comparison/leaderboard")
        write_report(comparison_summary(board), f"{out}/comparison/summary")
        write_report(best_model(board), f"{out}/comparison/recommendation")

    stages.run("comparison", comparison, ["baseline", "tuned", "validation_selected"], {}, ["comparison/leaderboard_table"],
               ["comparison/leaderboard", "comparison/summary", "comparison/recommendation"])
    board = read("comparison/leaderboard_table")
    winner = board.where(F.col("Rank") == 1).first()

    def evaluation():
        model = load_model(spark, f"{out}/models/{winner['Category']}")[0][winner["Model"]]
        write_table(predict_label(tables["test"], model), f"{out}/evaluation/test_predictions")
        cells = confusion_counts(read("evaluation/test_predictions"))
        write_report(confusion_matrix(cells), f"{out}/evaluation/confusion_matrix")
        write_report(classification_report(cells), f"{out}/evaluation/classification_report")
        save_model(spark, f"{out}/model", {"model": winner["Model"], "category": winner["Category"], "features": names,
                                           "classes": CLASSES}, action=model)

    stages.run("evaluation", evaluation, ["comparison", "test_selected"], {}, files=[
        "evaluation/test_predictions", "evaluation/confusion_matrix", "evaluation/classification_report", "model/metadata"])
    final = weighted_metrics(confusion_counts(read("evaluation/test_predictions"))).select(
        F.lit(winner["Model"]).alias("Model"), "Accuracy", "Precision", "Recall", "F1_Score",
        F.lit("Test").alias("Category"), F.lit(None).cast("int").alias("Rank"))
    return board.unionByName(final)


def fit_numbers(estimator, rows: DataFrame, names: list[str]) -> PipelineModel | Forest:
    """Fit on the selected number columns as they are."""
    if isinstance(estimator, BaggedTrees):
        rows = without_gaps(rows, [*names, "label"])
    if isinstance(estimator, RandomTrees | BaggedTrees):
        return random_trees(rows.select(*names, "label"), [Input(n) for n in names], "label", len(CLASSES), estimator)
    enable_checkpoints(rows.sparkSession)
    return Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), estimator]).fit(rows)


def balance_legacy(df: DataFrame, warning: int = 5000, emergency: int = 5000, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Add banded warning rows up to a target and banded emergency rows, with continued ids.

    Returns the whole table and its class distribution before and after.
    """
    columns = [ID, *INPUTS, RISK, ACTION]
    df = df.select(columns)
    seeds = filter_class(df, WARNING)
    missing = max(0, warning - class_counts(df, [WARNING])[WARNING])
    made, offset = df, 0
    for kind, n in (("warning", missing), ("emergency", emergency)):
        if n:
            drawn = sample_with_replacement(seeds, n, seed, stream=f"pick_{kind}")
            drawn = next_ids(df, drawn, offset=offset)
            made = made.unionByName(scenario_bands(drawn, kind, seed=seed).select(columns))
            offset += n
    before = class_distribution(df).withColumn("stage", F.lit("before"))
    after = class_distribution(made).withColumn("stage", F.lit("after"))
    return made, before.unionByName(after)
