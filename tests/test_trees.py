"""Node tables score as the fitted models do, in generated code and by arrays, in batch and on streams."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from frostline.operators import training
from frostline.operators.scoring import add_probabilities, predict_risk, score_shipments
from frostline.operators.trees import Forest, Input, forest_from_table, forest_of, linked, raw_scores
from frostline.schema import ACTION, CARGO, ID, INPUTS, PREDICTED_RISK, RISK, SEAL, WATTS, probability
from frostline.sources.models import load_forest, save_forest
from frostline.streaming.scoring import score_stream


@pytest.fixture(scope="module")
def regressor(readings):
    return training.fit_regressor(readings, training.legacy_regressors(share=0.02)["random_forest"])


@pytest.fixture(scope="module")
def labelled(readings, regressor):
    return training.prepare_labels(training.add_predicted_risk(readings, regressor)).cache()


def _widest(found, expected, columns):
    both = found.select(ID, *columns).join(expected.select(ID, *[F.col(c).alias(f"_{c}") for c in columns]), ID)
    assert both.count() == found.count() == expected.count()
    return max(both.agg(*[F.max(F.abs(F.col(c) - F.col(f"_{c}"))) for c in columns]).first())


@pytest.mark.parametrize("name", ["random_forest", "boosted_depthwise"])
@pytest.mark.parametrize("code_nodes", [0, 1_000_000])
def test_regression_nodes_equal_the_model(spark, readings, name, code_nodes):
    share = 0.004 if code_nodes else 0.02
    model = training.fit_regressor(readings, training.legacy_regressors(share=share)[name])
    forest = forest_of(spark, model)
    assert len(forest.input) > 3 and forest.link == "identity"
    found = raw_scores(readings, forest, "prediction", code_nodes).withColumn("prediction", F.get("prediction", F.lit(0)))
    assert _widest(found, model.transform(readings), ["prediction"]) < 1e-12 * 100


@pytest.mark.parametrize("make", [
    lambda: training.baseline_classifiers()["decision_tree"], lambda: training.classifiers(share=0.01)["random_forest"](),
    lambda: training.BoostedOneVsRest(maxIter=2, stepSize=0.03, maxDepth=5, weightCol="weight", seed=42)])
def test_class_nodes_equal_the_model(spark, labelled, make):
    model = training.fit_classifier(labelled, make())
    forest = forest_of(spark, model)
    names = [f"p{i}" for i in range(3)]
    expected = model.transform(labelled).withColumn("_p", vector_to_array("probability"))
    expected = expected.select(ID, *[F.col("_p")[i].alias(n) for i, n in enumerate(names)])
    for code_nodes in (0, 1_000_000):
        scores = raw_scores(labelled, forest, "s", code_nodes).withColumn("s", linked(F.col("s"), forest.link))
        found = scores.select(ID, *[F.col("s")[i].alias(n) for i, n in enumerate(names)])
        assert _widest(found, expected, names) < 1e-12


def test_saved_nodes_score_in_batch_and_stream(spark, readings, labelled, regressor, tmp_path):
    action = training.fit_classifier(labelled, training.baseline_classifiers()["decision_tree"])
    forests = []
    for name, model in (("risk", regressor), ("action", action)):
        save_forest(spark, str(tmp_path / name), forest_of(spark, model))
        forests.append(load_forest(spark, str(tmp_path / name)))
    rows = readings.drop(RISK)
    found, expected = (score_shipments(rows, 0.3, *models) for models in (forests, (regressor, action)))
    assert _widest(found, expected, [PREDICTED_RISK, "confidence"]) < 1e-6
    keep = [ID, "predicted_action", "risk_level"]
    assert found.select(keep).exceptAll(expected.select(keep)).count() == 0
    source = str(tmp_path / "source")
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    score_stream(stream, 0.3, str(tmp_path / "sink"), str(tmp_path / "progress"), *forests).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "sink")).select(keep).exceptAll(found.select(keep)).count() == 0


def test_scoring_stays_one_stage(spark, readings, regressor):
    forest = forest_of(spark, regressor)
    plan = predict_risk(readings, forest)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_missing_numbers_go_right(spark):
    nodes = spark.createDataFrame([(0, 0, 0, 1.0, 1, 2, [0.0], 2.0), (0, 1, -1, None, -1, -1, [5.0], 2.0), (0, 2, 1, 0.5, 3, 4, [0.0], 2.0),
                                   (0, 3, -1, None, -1, -1, [7.0], 2.0), (0, 4, -1, None, -1, -1, [9.0], 2.0)],
                                  "tree int, node int, input int, threshold double, left int, right int, value array<double>, weight double")
    inputs = spark.createDataFrame([(0, "a", None, 1.0, 2.0), (1, "b", "yes", 0.0, 1.0)],
                                   "input int, column string, category string, shift double, factor double")
    forest = forest_from_table(nodes, inputs, (1.0,))
    rows = spark.createDataFrame([(1.5, "no"), (1.6, "no"), (9.0, "yes"), (None, None), (float("nan"), "yes")], "a double, b string")
    for code_nodes in (0, 100):
        assert [r["s"] for r in raw_scores(rows, forest, "s", code_nodes).collect()] == [[11.0], [15.0], [19.0], [15.0], [19.0]]
    with pytest.raises(ValueError):
        forest_from_table(nodes.where("node <> 1"), inputs)
    with pytest.raises(ValueError):
        linked(F.col("s"), "identity")


def test_tables_of_a_model_give_it_back(spark):
    forest = Forest([Input(WATTS), Input(CARGO, "Dairy")], np.array([0, 3, 4]), np.array([0, -1, -1, -1]), np.array([700.0, 0, 0, 0]),
                    np.array([1, 1, 2, 3]), np.array([2, 1, 2, 3]), np.array([[0.0, 0.0], [1.0, 2.0], [3.0, 4.0], [5.0, 6.0]]),
                    np.array([0.5, 1.0]), (1.0, 0.0), "softmax")
    again = forest_from_table(*forest.table(spark), forest.base, forest.link)
    assert again.inputs == forest.inputs and again.base == forest.base
    for name in ("first", "input", "threshold", "left", "right", "value", "weight"):
        assert (getattr(again, name) == getattr(forest, name)).all()
    assert forest.walk(np.array([[600.0, 0.0], [800.0, 1.0]])).tolist() == [[6.5, 7.0], [7.5, 8.0]]
