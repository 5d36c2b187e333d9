"""Learners beat the trivial answer; saved models score the same; batch equals stream."""

import pytest
from pyspark.sql import functions as F

from frostline.operators import training
from frostline.operators.encoding import code_table, fit_labels, label_decode, label_encode, one_hot, standard_scale
from frostline.operators.evaluation import regression_metrics
from frostline.operators.sampling import stratified_split
from frostline.operators.scoring import predict_risk, score_shipments
from frostline.plans import staged
from frostline.plans.classification import run_classification
from frostline.plans.regression import run_regression
from frostline.plans.resume import content, stage_report
from frostline.plans.staged import STAGE_NAMES, balance_legacy, run_staged
from frostline.schema import ACTION, CARGO, CLASSES, EMERGENCY, ID, INPUTS, PREDICTED_RISK, RISK, SAFE, SENSORS, WARNING
from frostline.sources.models import load_model, save_model
from frostline.sources.tables import read_telemetry, write_table
from frostline.sources.versions import manifest

TARGETS = {SAFE: 400, WARNING: 120, EMERGENCY: 120}


@pytest.fixture(scope="module")
def parts(readings):
    split = stratified_split(readings)
    return tuple(split.where(F.col("split") == s).drop("split").cache() for s in ("train", "test"))


@pytest.mark.parametrize("name", ["linear", "random_forest", "boosted_depthwise"])
def test_regressors_beat_the_mean(parts, name):
    train, test = parts
    model = training.fit_regressor(train, training.legacy_regressors(share=0.05)[name])
    scored = predict_risk(test, model)
    assert regression_metrics(scored).first()["R2"] > 0.3
    assert scored.where(~F.col(PREDICTED_RISK).between(0, 100)).count() == 0


@pytest.fixture(scope="module")
def labelled(parts):
    train, test = parts
    risk = training.fit_regressor(train, training.legacy_regressors()["linear"])
    return risk, training.prepare_labels(training.add_predicted_risk(train, risk)).cache(), training.add_predicted_risk(test, risk).cache()


def test_boosted_classes_and_saved_models(spark, labelled, tmp_path):
    risk, train, test = labelled
    model = training.fit_classifier(train, training.classifiers(share=0.01)["boosted"]())
    scored = score_shipments(test.drop(PREDICTED_RISK, RISK), 0.3, risk, model)
    total = F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda a, v: a + v)
    assert scored.where(F.abs(total - 1.0) > 1e-5).count() == 0
    assert training.macro_f1(training.predict_label(test, model)) > 0.4  # always SAFE gives about 0.33
    save_model(spark, str(tmp_path / "m"), {"threshold": 0.3, "classes": CLASSES}, risk=risk, action=model)
    models, metadata = load_model(spark, str(tmp_path / "m"))
    again = score_shipments(test.drop(PREDICTED_RISK, RISK), metadata["threshold"], models["risk"], models["action"])
    keep = [ID, "predicted_action", "confidence", PREDICTED_RISK]
    assert scored.select(keep).exceptAll(again.select(keep)).count() == 0


def test_forests_and_search(labelled):
    _, train, test = labelled
    best, ranked = training.search_classifier(train, "forest_no_bootstrap", n_iter=2, folds=2, share=0.01)
    assert len(ranked) == 2 and ranked[0]["score"] >= ranked[1]["score"] and best == ranked[0]["settings"]
    model = training.fit_classifier(train, training.classifiers(share=0.01)["forest_no_bootstrap"](**best))
    assert training.macro_f1(training.predict_label(test, model)) > 0.4


def test_regressor_search(parts):
    train, _ = parts
    rows = training.stratified_split(train, ACTION, {"a": 0.5, "b": 0.5}).withColumnRenamed("split", "stratum")
    best, ranked = training.search_regressor(rows, "random_forest", "stratum", n_iter=1, folds=2, share=0.01)
    assert len(ranked) == 1 and ranked[0]["score"] > 0.3 and set(best) == {"numTrees", "maxDepth", "minInstancesPerNode"}


def test_settings_are_repeatable():
    grid = training.CLASSIFIER_GRIDS["random_forest"]
    first = training.draw_settings(grid, 20, 42)
    assert first == training.draw_settings(grid, 20, 42) and len({str(s) for s in first}) == 20
    assert len(training.draw_settings(grid, 100, 1)) == 36


def test_importance_and_elimination(readings):
    found = training.forest_importance(readings, SENSORS, RISK, trees=5, depth=4).collect()
    assert sum(r["importance"] for r in found) == pytest.approx(1.0) and len(found) == len(SENSORS)
    ranked = training.recursive_feature_elimination(readings, SENSORS, RISK, k=3, trees=3, depth=3).collect()
    assert sorted(r["ranking"] for r in ranked) == [1, 1, 1, 2, 3] and sum(r["selected"] for r in ranked) == 3


def test_labels(spark, readings):
    assert fit_labels(readings, ACTION) == sorted(CLASSES)
    assert fit_labels(readings, ID, limit=10) is None
    small = label_encode(readings, CARGO).select(ID, "code")
    large = label_encode(readings, CARGO, limit=1).select(ID, "code")  # the path for any number of labels
    assert small.exceptAll(large).count() == 0
    assert [r["code"] for r in code_table(readings, ID).orderBy(ID).limit(3).collect()] == [0, 1, 2]
    unseen = spark.createDataFrame([("Fish",)], f"{CARGO} string")
    assert label_encode(unseen, CARGO, ["Dairy"]).first()["code"] is None
    assert one_hot(unseen, CARGO, ["Dairy"]).first()[f"{CARGO}_Dairy"] == 0
    assert label_decode(spark.createDataFrame([(7,), (0,)], "code int"), "code", ["x"]).collect()[0]["label"] is None


def test_scaling_a_constant(spark):
    rows = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "a double, b double")
    assert [tuple(r) for r in standard_scale(rows, ["a", "b"]).collect()] == [(0.0, -1.0), (0.0, 1.0)]


@pytest.mark.parametrize("fmt", ["csv", "parquet", "orc", "json"])
def test_tables_read_back(spark, readings, tmp_path, fmt):
    path = str(tmp_path / fmt)
    write_table(readings.select(read_columns()), path, fmt=fmt)
    back = read_telemetry(spark, path, fmt).select(read_columns())
    assert back.exceptAll(readings.select(read_columns())).count() == 0 and back.count() == readings.count()


def read_columns():
    return [ID, *INPUTS, RISK, ACTION]


def test_malformed_csv_is_an_error(spark, readings, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(",".join(read_columns()) + "\nX,Dairy,warm,2,2,600,0.9,10,SAFE_Maintain_Course\n")
    with pytest.raises(Exception):
        read_telemetry(spark, str(path)).collect()
    with pytest.raises(ValueError):
        read_telemetry(spark, str(path), "xml")


def test_regression_run(spark, readings, tmp_path):
    report = run_regression(readings, str(tmp_path), augment=True, share=0.004, warning=60, emergency=40)
    rows = report.collect()
    assert [r["split"] for r in rows] == ["validation"] * 3 + ["test"] and sum(r["chosen"] for r in rows) == 2
    predictions = spark.read.parquet(f"{tmp_path}/test_predictions")
    assert predictions.where("Lower_90pct_Interval > Upper_90pct_Interval").count() == 0
    models, metadata = load_model(spark, f"{tmp_path}/model")
    assert metadata["model"] == rows[-1]["Model"] and "risk" in models


def test_classification_run(spark, readings, tmp_path):
    report = run_classification(readings, str(tmp_path), targets=TARGETS, share=0.005, n_iter=1, folds=2, candidates=["random_forest"])
    rows = report.collect()
    assert [r["split"] for r in rows] == ["validation", "test"] and 0.05 <= rows[-1]["warning_threshold"] <= 0.61
    _, metadata = load_model(spark, f"{tmp_path}/model")
    assert metadata["training_distribution"] == TARGETS and metadata["classes"] == CLASSES
    assert spark.read.parquet(f"{tmp_path}/test_predictions").count() == rows[-1]["samples"]


STAGED_RUN = dict(targets=TARGETS, share=0.005, n_iter=1, folds=2, tuned=("random_forest",))


@pytest.fixture(scope="module")
def unbroken(spark, readings, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("staged"))
    return out, run_staged(readings, out, **STAGED_RUN).collect()


def test_staged_run(spark, unbroken):
    out, rows = unbroken
    assert [r["Rank"] for r in rows if r["Rank"]] == [1, 2, 3, 4, 5] and rows[-1]["Category"] == "Test"
    _, metadata = load_model(spark, f"{out}/model")
    assert RISK not in metadata["features"]


def test_broken_staged_run_goes_on(spark, readings, unbroken, tmp_path, monkeypatch):
    """Broken in its sixth stage, a run goes on there and leaves the rows that an unbroken one does; new settings rerun what needs them.

    Chosen features and fitted models aren't compared: bagging goes by the order of rows, which two runs don't share.
    """
    broken, (whole, whole_board) = str(tmp_path), unbroken
    plain, calls = staged.features_staged, []

    def breaks(rows):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("stopped in the sixth stage")
        return plain(rows)

    with monkeypatch.context() as patch:
        patch.setattr(staged, "features_staged", breaks)
        with pytest.raises(OSError):
            run_staged(readings, broken, **STAGED_RUN, resume=True)
    states = {r["stage"]: r["state"] for r in stage_report(spark, broken, STAGE_NAMES).collect()}
    assert states == {**dict.fromkeys(STAGE_NAMES[:5], "done"), STAGE_NAMES[5]: "open"}
    board = run_staged(readings, broken, **STAGED_RUN, resume=True).collect()
    report = stage_report(spark, broken, STAGE_NAMES).collect()
    assert [r["attempts"] for r in report] == [2 if i == 5 else 1 for i in range(13)] and {r["state"] for r in report} == {"done"}
    assert [r["stage"] for r in report] == list(STAGE_NAMES) and {(r["Category"], r["Model"]) for r in board[:-1]} == {
        (r["Category"], r["Model"]) for r in whole_board[:-1]}
    for name in ("split", "validation_features", "test_features"):
        mine, other = (manifest(spark, f"{out}/_stages/{name}")["tables"] for out in (broken, whole))
        assert mine == other
    for table in ("balanced_train", "engineered_train", "selected/train", "selected/validation", "selected/test"):
        mine, other = (spark.read.parquet(f"{out}/{table}") for out in (broken, whole))
        assert mine.count() == other.count()
        assert mine.select(ID).exceptAll(other.select(ID)).isEmpty()
    assert run_staged(readings, broken, **STAGED_RUN, resume=True).collect() == board
    run_staged(readings, broken, **{**STAGED_RUN, "folds": 3}, resume=True)
    again = {r["stage"]: r["attempts"] for r in stage_report(spark, broken, STAGE_NAMES).collect()}
    assert again["tuned"] == 2 and again["comparison"] == 2 and again["baseline"] == 1 and again["selection"] == 1


def test_content_knows_rows_not_their_order(spark):
    kind = "a int, b string"
    rows = [(1, "x"), (None, "y"), (2, None), (2, None)]
    same = content(spark.createDataFrame(rows, kind))
    assert same == content(spark.createDataFrame(rows[::-1], kind).repartition(3).select("b", "a")) and same["rows"] == 4
    others = [rows[:3], [*rows, (2, None)], [(1, "x"), (None, "y"), (2, None), (2, "")], []]
    assert len({same["hash"], *(content(spark.createDataFrame(o, kind))["hash"] for o in others)}) == 5
    assert content(spark.createDataFrame([(None, 1)], "a int, b int"))["hash"] != content(spark.createDataFrame([(1, None)], "a int, b int"))["hash"]


def test_legacy_balance(readings):
    made, report = balance_legacy(readings, warning=200, emergency=150)
    counts = {(r["stage"], r["class"]): r["count"] for r in report.collect()}
    assert counts[("after", WARNING)] == 200 and counts[("after", EMERGENCY)] == counts[("before", EMERGENCY)] + 150
    assert made.select(ID).distinct().count() == made.count()


def test_the_registered_resumed_run_is_whole(spark, readings, monkeypatch):
    """All trees, draws, folds and tuned forests: the query gives targets and the wish to resume, and nothing else."""
    from frostline.catalog import runs

    asked = []
    monkeypatch.setattr(runs, "telemetry", lambda *_: readings)
    monkeypatch.setattr(runs, "run_staged", lambda rows, out, **settings: asked.append(settings) or readings.limit(1))
    monkeypatch.setattr(runs, "stage_report", lambda *_: spark.createDataFrame([(1, "split", "done", 1, 5, 1)], "number int, stage string, state string, tables int, rows bigint, attempts int"))
    runs.QUERIES["run_staged_resumed"](spark, "")
    assert [sorted(s) for s in asked] == [["resume", "targets"]] * 2
