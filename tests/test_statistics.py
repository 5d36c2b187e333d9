"""Profiles, selection and metrics against pandas, numpy and the published relations."""

import random
import struct
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from frostline.operators import evaluation, profiling, quantiles, selection
from frostline.schema import NUMERIC, RISK, SAFE, SENSORS, WARNING


def _pairs(rows):
    return {(r["feature_1"], r["feature_2"]): r["correlation"] for r in rows.collect()}


def _by_hand(monkeypatch, few, stored):
    """Scans that refine further than so few rows need, and cells that are kept in a table."""
    monkeypatch.setattr(quantiles, "FEW_ROWS", few)
    if stored:
        monkeypatch.setattr(quantiles, "table_if_small", lambda df: None)


def test_sort_keys_are_the_bits_in_order(spark):
    rng = random.Random(1)
    values = [0.0, 5e-324, sys.float_info.min, np.nextafter(sys.float_info.min, 0.0), sys.float_info.max, float("inf"), 1.0, 0.1]
    values += [v for k in range(-1074, 1024, 7) for v in (2.0 ** k, np.nextafter(2.0 ** k, 0.0), np.nextafter(2.0 ** k, np.inf))]
    drawn = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(63)))[0] for _ in range(2000)]
    values = [float(v) for v in values + drawn if v == v]
    rows = spark.createDataFrame([(s * v,) for v in values for s in (1, -1)], "value double")
    for r in quantiles.with_sort_key(rows).collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(r["value"])))[0]
        assert r["key"] == (-bits if r["value"] < 0 else bits)


@pytest.mark.parametrize("partitions,width,few,stored", [(1, "8", 1_000_000, False), (1, "8", 0, False), (8, "40", 0, True)])
def test_quantiles_equal_numpy(spark, monkeypatch, partitions, width, few, stored):
    """The same from two scans and from four, with the cells in memory and in a table."""
    _by_hand(monkeypatch, few, stored)
    values = np.concatenate([np.full(3000, 7.25), np.random.default_rng(1).normal(size=3001), [1e9, -1e9]])
    rows = spark.createDataFrame([(float(v), None if v > 2 else float(v)) for v in values], "a double, b double")
    rows = rows.unionByName(spark.createDataFrame([(float("nan"), float("nan"))], "a double, b double")).repartition(partitions)
    probs = [0.0, 0.05, 0.25, 0.5, 0.77, 0.95, 1.0]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        found = {r["feature"]: [r[f"q{i}"] for i in range(len(probs))] for r in quantiles.quantiles(rows, ["a", "b"], probs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    np.testing.assert_allclose(found["a"], np.quantile(values, probs), rtol=1e-12)
    np.testing.assert_allclose(found["b"], np.quantile(values[values <= 2], probs), rtol=1e-12)


@pytest.mark.parametrize("few,stored", [(1_000_000, False), (0, True)])
def test_grouped_quantiles_equal_numpy(spark, monkeypatch, few, stored):
    _by_hand(monkeypatch, few, stored)
    rng = np.random.default_rng(5)
    names = ("x", "y", None)
    frame = [(names[i % 3], float(v), float(round(v, 1)) if i % 5 else None) for i, v in enumerate(rng.normal(size=20_001))]
    rows = spark.createDataFrame(frame, "g string, a double, b double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = {(r["g"], r["feature"]): [r[f"q{i}"] for i in range(5)] for r in quantiles.quantiles(rows, ["a", "b"], probs, ["g"]).collect()}
    for g in names:
        a = [f[1] for f in frame if f[0] == g]
        b = [f[2] for f in frame if f[0] == g and f[2] is not None]
        np.testing.assert_allclose(found[(g, "a")], np.quantile(a, probs), rtol=1e-12)
        np.testing.assert_allclose(found[(g, "b")], np.quantile(b, probs), rtol=1e-12)


@pytest.mark.parametrize("few,stored", [(1_000_000, False), (0, True)])
def test_quantiles_of_infinities(spark, monkeypatch, few, stored):
    """Missing values are left out; between equal infinities lies the same infinity; zero has no sign."""
    _by_hand(monkeypatch, few, stored)
    inf = float("inf")
    values = [-inf, -inf, -inf, 1.0, 2.0, 3.0, inf, inf, inf, inf, inf]
    rows = spark.createDataFrame([(v,) for v in [*values, float("nan"), None]], "a double")
    probs = [0.0, 0.1, 0.3, 0.4, 0.75, 1.0]
    found = quantiles.quantiles(rows, ["a"], probs).first()
    assert [found[f"q{i}"] for i in range(6)] == [-inf, -inf, 1.0, 2.0, inf, inf]
    zeros = spark.createDataFrame([(v,) for v in (-0.0, 0.0, -0.0, 5e-324, -5e-324)], "a double")
    found = quantiles.quantiles(zeros, ["a"], [0.0, 0.25, 0.5, 0.75, 1.0]).first()
    assert [repr(found[f"q{i}"]) for i in range(5)] == ["-5e-324", "0.0", "0.0", "0.0", "5e-324"]


@pytest.mark.parametrize("spread", [1e-300, 1e-12, 1e300])
def test_quantiles_of_close_and_far_values(spark, monkeypatch, spread):
    """Values that differ in their last bits only, or by hundreds of powers of ten."""
    _by_hand(monkeypatch, 0, False)
    values = np.concatenate([1.0 + np.arange(500) * 2.0 ** -52, np.geomspace(spread, 1.0, 500), -np.geomspace(spread, 1.0, 500)])
    rows = spark.createDataFrame([(float(v),) for v in values], "a double").repartition(5)
    found = quantiles.quantiles(rows, ["a"], [0.1, 0.5, 0.9, 0.999]).first()
    np.testing.assert_allclose([found[f"q{i}"] for i in range(4)], np.quantile(values, [0.1, 0.5, 0.9, 0.999]), rtol=1e-15)


def test_running_counts_equal_ranks(spark):
    rng = np.random.default_rng(8)
    values = np.concatenate([rng.normal(size=500).round(1), rng.normal(size=500) * 1e-9, [0.0, -0.0]])
    rows = spark.createDataFrame([(float(v),) for v in values], "a double")
    for r in quantiles.running_counts(quantiles.value_counts(rows, ["a"])).collect():
        assert (r["before"], r["n"], r["total"]) == ((values < r["value"]).sum(), (values == r["value"]).sum(), len(values))


def test_quantile_scans_sort_no_values(spark, readings, monkeypatch):
    """Only cells are sorted, for their running counts, and only cells are shuffled."""
    plans = []
    settled = quantiles._settled
    monkeypatch.setattr(quantiles, "_settled", lambda cells: plans.append(cells._jdf.queryExecution().executedPlan().toString()) or settled(cells))
    quantiles.quantiles(readings, NUMERIC, [0.25, 0.5])
    moved = [line for p in plans for line in p.splitlines() if "Sort [" in line or "Exchange hash" in line]
    assert len(plans) == 2 and moved and not any("value" in line or "key" in line for line in moved)


def test_quantiles_without_groups_count_arrays(spark, monkeypatch):
    """No reading becomes a row of its own; pieces of a column, empty ones too, add up to the same quantiles."""
    plans = []
    settled = quantiles._settled
    monkeypatch.setattr(quantiles, "_settled", lambda cells: plans.append(cells._jdf.queryExecution().executedPlan().toString()) or settled(cells))
    rng = np.random.default_rng(3)
    many, few = rng.normal(size=5000) * 1e-3, np.round(rng.normal(size=5000), 1)
    frame = [(None if i < 700 else float(a), int(10 * b)) for i, (a, b) in enumerate(zip(many, few))]
    rows = spark.createDataFrame(frame, "a double, k bigint").coalesce(2)
    monkeypatch.setattr(quantiles, "_TOGETHER", 600)
    monkeypatch.setattr(quantiles, "FEW_ROWS", 0)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        found = {r["feature"]: [r[f"q{i}"] for i in range(4)] for r in quantiles.quantiles(rows, ["a", "k"], [0.0, 0.3, 0.5, 1.0]).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(plans) >= 2 and not any("Expand" in p or "Generate" in p for p in plans)
    np.testing.assert_allclose(found["a"], np.quantile(many[700:], [0.0, 0.3, 0.5, 1.0]), rtol=1e-15)
    np.testing.assert_allclose(found["k"], np.quantile([k for _, k in frame], [0.0, 0.3, 0.5, 1.0]), rtol=1e-15)


def test_sort_keys_of_arrays_are_the_same(spark):
    values = [0.0, -0.0, 5e-324, -5e-324, 1.5, -1.5, 1e308, -1e308, float("inf"), float("-inf"), sys.float_info.min]
    rows = spark.createDataFrame([(v,) for v in values], "value double")
    keys = {repr(r["value"]): r["key"] for r in quantiles.with_sort_key(rows).collect()}
    assert quantiles.sort_keys(np.array(values)).tolist() == [keys[repr(v)] for v in values]
    assert quantiles._values_of(quantiles.sort_keys(np.array(values))).tolist() == values


def test_quantiles_edge_inputs(spark):
    assert quantiles.quantiles(spark.createDataFrame([], "a double"), ["a"], [0.5]).count() == 0
    one = quantiles.quantiles(spark.createDataFrame([(3.0,)], "a double"), ["a"], [0.0, 0.5, 1.0]).first()
    assert [one["q0"], one["q1"], one["q2"]] == [3.0, 3.0, 3.0]


def test_sketched_quantiles_are_close(readings):
    exact = {r["feature"]: r["q0"] for r in quantiles.quantiles(readings, NUMERIC, [0.5]).collect()}
    near = {r["feature"]: r["q0"] for r in quantiles.quantiles(readings, NUMERIC, [0.5], accuracy=10_000).collect()}
    spread = {c: readings.agg(F.max(c) - F.min(c)).first()[0] for c in NUMERIC}
    assert all(abs(exact[c] - near[c]) <= 0.02 * spread[c] for c in NUMERIC)


def test_describe_empty_table(readings):
    rows = profiling.numerical_statistics(readings.limit(0)).collect()
    assert len(rows) == len(NUMERIC) and all(r["count"] == 0 and r["mean"] is None for r in rows)


def test_correlations_equal_pandas(readings):
    frame = readings.select(NUMERIC).toPandas()
    for build, method in ((profiling.pearson_matrix, "pearson"), (profiling.spearman_matrix, "spearman")):
        expected = frame.corr(method=method)
        for (a, b), value in _pairs(build(readings)).items():
            assert value == pytest.approx(expected.loc[a, b], abs=1e-9)


def test_pearson_with_gaps_and_constants(spark, readings):
    gappy = readings.select(F.when(F.col(RISK) < 30, F.col(RISK)).alias("a"), F.col(SENSORS[4]).alias("b"), F.lit(2.0).alias("c"))
    expected = gappy.toPandas().corr()
    found = _pairs(profiling.pearson_matrix(gappy, ["a", "b", "c"]))
    assert found[("a", "b")] == pytest.approx(expected.loc["a", "b"], abs=1e-9)
    assert found[("a", "c")] is None and found[("c", "c")] is None and found[("a", "a")] == pytest.approx(1.0)


def test_outliers_of_a_constant(spark):
    rows = spark.createDataFrame([(1.0,)] * 10 + [(5.0,)], "a double")
    row = profiling.iqr_outliers(rows, ["a"]).first()
    assert row["iqr"] == 0.0 and row["outlier_count"] == 1 and row["outlier_percentage"] == 9.09
    bins = profiling.histogram(rows.limit(10), "a", 4).collect()
    assert [r["count"] for r in bins] == [10, 0, 0, 0]


def test_binned_distribution_edges(spark):
    rows = spark.createDataFrame([(v,) for v in (0.0, 10.0, 10.5, 100.0, 101.0, -1.0, None)], f"{RISK} double")
    assert [r["count"] for r in profiling.binned_distribution(rows).collect()] == [2, 1, 0, 0, 0, 0, 0, 0, 0, 1]


def test_duplicates(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None)], "x int, y string")
    assert profiling.duplicate_count(rows).first()[0] == 3
    assert profiling.duplicate_count(rows.limit(0)).first()[0] == 0


def test_published_class_shares(spark):
    rows = spark.range(56_000).select(F.when(F.col("id") < 134, F.lit(WARNING)).otherwise(SAFE).alias("c"))
    found = [(r["class"], r["count"], r["percentage"]) for r in profiling.class_distribution(rows, "c").collect()]
    assert found == [(SAFE, 55_866, pytest.approx(99.76071428571429)), (WARNING, 134, pytest.approx(0.23928571428571427))]


def test_class_comparison_needs_both(readings):
    assert profiling.class_mean_comparison(readings.where(F.col("Logistics_Action_Recommendation") == SAFE)).count() == 0


def test_vif_equals_regression(readings):
    x = readings.select(SENSORS).toPandas().to_numpy()
    found = {r["feature"]: r["vif"] for r in selection.vif_scores(readings, SENSORS).collect()}
    for i, name in enumerate(SENSORS):
        others = np.delete(x, i, axis=1)
        fit = others @ np.linalg.lstsq(others, x[:, i], rcond=None)[0]
        r2 = 1 - ((x[:, i] - fit) ** 2).sum() / (x[:, i] ** 2).sum()
        assert found[name] == pytest.approx(1 / (1 - r2), rel=1e-6)
    doubled = readings.withColumn("twin", F.col(SENSORS[0]) * 2)
    found = {r["feature"]: r["vif"] for r in selection.vif_scores(doubled, [*SENSORS, "twin"]).collect()}
    assert found["twin"] == found[SENSORS[0]] == float("inf") and found[SENSORS[3]] < 1e6


def test_vif_of_nearly_dependent_columns(spark):
    """Columns whose products are dependent to the last bit, while the columns are not."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 3))
    x = np.column_stack([x, x[:, 0] + x[:, 1] + 3e-8 * rng.normal(size=3000), 1e6 * x[:, 2] + rng.normal(size=3000)])
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x] + [(None, 1.0, 1.0, 1.0, 1.0)], "a double, b double, c double, d double, e double")
    for frame, together in ((rows.repartition(7), 3), (rows.coalesce(1), 64)):
        factor = selection.triangular_factor(frame, list("abcde"), together)
        assert np.allclose(np.abs(factor), np.abs(np.linalg.qr(x, mode="r")), rtol=1e-6, atol=1e-6)
    found = {r["feature"]: r["vif"] for r in selection.vif_scores(rows.repartition(7), list("abcde")).collect()}
    for i, name in enumerate("abcde"):
        others = np.delete(x, i, axis=1)
        left = x[:, i] - others @ np.linalg.lstsq(others, x[:, i], rcond=None)[0]
        assert found[name] == pytest.approx((x[:, i] @ x[:, i]) / (left @ left), rel=2e-2)
    assert found["d"] > 1e14 and found["d"] < float("inf")
    assert selection.vif_scores(rows.limit(2), list("ab")).count() == 2


def test_density_equals_a_sum_of_kernels(spark):
    values = np.random.default_rng(4).normal(10, 3, 2000)
    rows = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),), (float("inf"),)], "a double").repartition(4)
    curve = profiling.density_curve(rows, "a", 400).collect()
    width = values.std(ddof=1) * len(values) ** -0.2
    plain = [np.exp(-0.5 * ((r["value"] - values) / width) ** 2).sum() / (len(values) * width * np.sqrt(2 * np.pi)) for r in curve]
    assert max(abs(p - r["density"]) for p, r in zip(plain, curve)) < 1e-3 * max(plain)
    step = curve[1]["value"] - curve[0]["value"]
    assert sum(r["density"] for r in curve) * step == pytest.approx(1.0, abs=2e-3) and len(curve) == 400
    assert profiling.density_curve(rows.where("a = 1"), "a").count() == 0
    assert profiling.density_curve(spark.createDataFrame([(2.0,)] * 5, "a double"), "a").count() == 0


def _digamma(x):
    steps = 200
    y = x + steps
    return np.log(y) - 0.5 / y - 1 / (12 * y * y) - sum(1 / (x + i) for i in range(steps))


def _neighbours_by_hand(x, cls, k=3):
    sizes = {c: (cls == c).sum() for c in set(cls)}
    kept = np.array([sizes[c] > 1 for c in cls])
    x, cls, total = x[kept], cls[kept], 0.0
    for v, c in zip(x, cls):
        mine = min(k, sizes[c] - 1)
        radius = np.sort(np.abs(x[cls == c] - v))[mine]  # the value itself comes first
        near = (np.abs(x - v) < radius).sum() if radius > 0 else (x == v).sum()
        total += _digamma(mine) - _digamma(sizes[c]) - _digamma(near)
    return max(0.0, _digamma(len(x)) + total / len(x))


def test_neighbour_information_equals_all_distances(spark):
    rng = np.random.default_rng(6)
    cls = rng.choice(["a", "b", "c"], 400, p=[0.8, 0.19, 0.01])
    cls[:3], cls[3:5] = "few", "two"
    cls[5] = "alone"
    x = np.column_stack([rng.normal(size=400) + (cls == "b") * 2, rng.integers(0, 12, 400) * 0.25, np.round(rng.normal(size=400), 1) * (cls != "c")])
    rows = spark.createDataFrame([(c, *map(float, r)) for c, r in zip(cls, x)] + [("a", None, float("nan"), float("inf")), (None, 1.0, 1.0, 1.0)],
                                 "c string, x double, y double, z double").repartition(5)
    found = {r["feature"]: r["mutual_information"] for r in profiling.neighbour_information(rows, ["x", "y", "z"], "c").collect()}
    for i, name in enumerate("xyz"):
        assert found[name] == pytest.approx(_neighbours_by_hand(x[:, i], cls), abs=1e-9)
    assert found["x"] > found["y"]
    assert profiling.neighbour_information(rows.limit(0), ["x"], "c").count() == 0


def test_published_confusion_matrix(spark):
    counts = {(SAFE, SAFE): 11_893, (SAFE, WARNING): 78, (WARNING, SAFE): 22, (WARNING, WARNING): 7}
    cells = spark.createDataFrame([(a, p, n) for (a, p), n in counts.items()], "actual string, predicted string, n bigint")
    holdout = evaluation.holdout_metrics(cells, 0.13).first()
    assert holdout["macro_f1_observed_classes"] == pytest.approx(0.5593102323757144)
    assert holdout["warning_recall"] == pytest.approx(0.2413793103448276) and holdout["samples"] == 12_000
    report = {r["class"]: r for r in evaluation.classification_report(cells).collect()}
    assert report["accuracy"]["f1"] == pytest.approx(0.9916666666666667)
    assert report["macro avg"]["f1"] == pytest.approx(0.5593102323757144)


def test_published_leaderboard(spark):
    schema = "Model string, Accuracy double, Precision double, Recall double, F1_Score double"
    baseline = spark.createDataFrame([
        ("DecisionTree", 0.9991666666666666, 1.0, 0.9991666666666666, 0.999496527777778),
        ("RandomForest", 0.999, 1.0, 0.999, 0.9993695652173912),
        ("ExtraTrees", 0.9983333333333332, 0.998464355523094, 0.9983333333333332, 0.9982715624647236),
        ("LogisticRegression", 0.99275, 0.9979357968881414, 0.99275, 0.9948908898435268)], schema)
    tuned = spark.createDataFrame([
        ("RandomForest", 0.9988333333333334, 1.0, 0.9988333333333334, 0.9992310606060608),
        ("ExtraTrees", 0.9983333333333332, 0.998464355523094, 0.9983333333333332, 0.9982715624647236)], schema)
    board = evaluation.model_leaderboard(baseline, tuned)
    found = [(r["Model"], r["Category"]) for r in board.orderBy("Rank").collect()]
    assert found == [("DecisionTree", "Baseline"), ("RandomForest", "Baseline"), ("RandomForest", "Tuned"),
                     ("ExtraTrees", "Baseline"), ("ExtraTrees", "Tuned"), ("LogisticRegression", "Baseline")]
    summary = evaluation.comparison_summary(board).first()
    assert (summary["total_models"], summary["baseline_models"], summary["tuned_models"], summary["best_model"]) == (6, 4, 2, "DecisionTree")
    assert evaluation.best_model(board).first()["Model"] == "DecisionTree"


def test_published_selection(spark):
    information = [("Forecasted_4Hr_Spoilage_Risk_Pct", 0.8387), ("Actual_Internal_Temp_C", 0.7156), ("Temperature_Risk_Index", 0.6573),
                   ("Temperature_Deviation", 0.6493), ("Seal_Integrity_Index", 0.635), ("Thermal_Stress_Index", 0.6118), ("Seal_Loss", 0.5964),
                   ("HVAC_Efficiency", 0.5921), ("Ambient_Load", 0.5557), ("Cooling_Performance_Score", 0.532), ("Ambient_External_Temp_C", 0.5222),
                   ("Cooling_Stress", 0.51251), ("Overall_Risk_Score", 0.51195), ("HVAC_Load_Ratio", 0.51178), ("HVAC_Power_Consumption_Watts", 0.4621),
                   ("Internal_Set_Point_C", 0.4225), ("Cargo_Type", 0.0026)]
    forest = [("Forecasted_4Hr_Spoilage_Risk_Pct", 0.3069), ("Actual_Internal_Temp_C", 0.1501), ("Temperature_Deviation", 0.1042),
              ("Seal_Integrity_Index", 0.0976), ("Internal_Set_Point_C", 0.0805), ("Temperature_Risk_Index", 0.08), ("HVAC_Power_Consumption_Watts", 0.045),
              ("Thermal_Stress_Index", 0.0364), ("Seal_Loss", 0.0223), ("HVAC_Efficiency", 0.0219), ("Cooling_Performance_Score", 0.0121),
              ("Cooling_Stress", 0.0101), ("Overall_Risk_Score", 0.0098), ("Ambient_Load", 0.0087), ("Ambient_External_Temp_C", 0.0079),
              ("HVAC_Load_Ratio", 0.0046), ("Cargo_Type", 0.0019)]
    dropped = spark.createDataFrame([(c,) for c in ("Actual_Internal_Temp_C", "Ambient_Load", "Cooling_Stress", "Overall_Risk_Score")], "feature string")
    expected = ["Ambient_External_Temp_C", "Cooling_Performance_Score", "Forecasted_4Hr_Spoilage_Risk_Pct", "HVAC_Efficiency",
                "HVAC_Power_Consumption_Watts", "Seal_Integrity_Index", "Seal_Loss", "Temperature_Deviation", "Temperature_Risk_Index",
                "Thermal_Stress_Index"]
    mi = spark.createDataFrame(information, "feature string, mutual_information double")
    rf = spark.createDataFrame(forest, "feature string, importance double")
    assert selection.require_selection(selection.consensus_select(mi, rf, dropped)) == expected
    report = selection.selection_report(selection.consensus_select(mi, rf, dropped)).first()
    assert report["selected_feature_count"] == 10 and report["selected_features"] == expected
    leak = selection.consensus_select(mi, rf, dropped, leakage=[RISK])
    assert RISK not in selection.require_selection(leak)
    with pytest.raises(ValueError):
        selection.require_selection(leak.limit(0))


def test_published_importance_threshold(spark):
    rows = [("Temperature_Deviation_C", 0.8467), ("HVAC_Power_Consumption_Watts", 0.069), ("Actual_Internal_Temp_C", 0.0212),
            ("HVAC_Efficiency", 0.0158), ("HVAC_Stress_Index", 0.0129), ("Seal_Integrity_Index", 0.0097), ("Cargo_Type", 0.0003)]
    kept = selection.importance_threshold(spark.createDataFrame(rows, "feature string, importance double")).collect()
    assert [r["feature"] for r in kept] == [name for name, _ in rows[:5]]


def test_threshold_sweep_equals_direct_passes(spark):
    grid = evaluation.threshold_grid()
    np.testing.assert_array_equal(grid, np.arange(0.05, 0.61, 0.01))
    scores = [*grid[::3], 0.049999, 0.6000001, 0.0, 1.0, 0.3, 0.31]
    rows = [(s, WARNING if i % 3 else SAFE) for i, s in enumerate(scores)]
    frame = spark.createDataFrame(rows, f"`Probability_{WARNING}` double, Logistics_Action_Recommendation string")
    swept = {r["threshold"]: r["score"] for r in evaluation.threshold_sweep(frame).collect()}
    best, best_score = None, -1.0
    for t in grid:
        flagged = [label for s, label in rows if s >= t]
        hits = sum(label == WARNING for label in flagged)
        recall = hits / sum(label == WARNING for _, label in rows)
        precision = hits / len(flagged) if flagged else 0.0
        score = 0.7 * recall + 0.3 * precision
        assert swept[t] == pytest.approx(score, abs=1e-12)
        if score > best_score:
            best, best_score = t, score
    assert evaluation.calibrate_threshold(frame).first()["threshold"] == best


def test_upsert(spark):
    schema = "Model string, R2 double"
    old = spark.createDataFrame([("a", 0.5), ("b", 0.9)], schema)
    new = spark.createDataFrame([("a", 0.95), ("c", 0.1)], schema)
    assert [tuple(r) for r in evaluation.upsert_leaderboard(old, new).collect()] == [("a", 0.95), ("b", 0.9), ("c", 0.1)]


def test_weights_of_present_classes(spark):
    rows = spark.createDataFrame([(SAFE,)] * 6 + [(WARNING,)] * 2, "Logistics_Action_Recommendation string")
    found = {r[0]: r["weight"] for r in evaluation.balanced_weights(rows).distinct().collect()}
    assert found == {SAFE: pytest.approx(8 / 12), WARNING: 2.0}
