"""The five request cases, null handling and half-even rounding."""

import pytest
from pyspark.sql import functions as F

from frostline.functions import decisions
from frostline.functions.features import features_regression, features_staged
from frostline.functions.numeric import clip, edges_below, half_even
from frostline.operators import scoring
from frostline.operators.contracts import (
    apply_feature_selection, quarantined_rows, require_class_counts, require_columns, require_finite, require_not_null,
    valid_rows, validate_ranges,
)
from frostline.schema import EMERGENCY, INPUTS, SAFE, WARNING, WATTS

SCHEMA = "name string, " + ", ".join(f"{c} {'string' if c == 'Cargo_Type' else 'double'}" for c in INPUTS)
CASES = [
    ("safe", "Frozen Food", 24.0, -18.0, -18.0, 1200.0, 0.98),
    ("warning", "Frozen Food", 38.0, -18.0, -14.0, 1700.0, 0.72),
    ("emergency", "Frozen Food", 42.0, -18.0, -8.0, 2200.0, 0.40),
    ("bad seal", "Frozen Food", 25.0, -18.0, -18.0, 1200.0, 1.5),
    ("bad power", "Frozen Food", 25.0, -18.0, -18.0, -100.0, 0.95),
    ("no seal", "Frozen Food", 42.0, -18.0, -8.0, 1200.0, None),
]


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame(CASES, SCHEMA)


def test_ranges(cases):
    marked = validate_ranges(cases)
    found = {r["name"]: r["violations"] for r in marked.collect()}
    assert found["safe"] == found["warning"] == found["emergency"] == []
    assert found["bad seal"] == found["no seal"] == ["Seal_Integrity_Index"]
    assert found["bad power"] == [WATTS]
    assert valid_rows(marked).count() == 3 and quarantined_rows(marked).count() == 3
    assert {r["name"] for r in cases.where(decisions.in_ranges()).collect()} == {"safe", "warning", "emergency"}
    nan = cases.where("name = 'safe'").withColumn(WATTS, F.lit(float("nan")))
    assert nan.where(decisions.in_ranges()).count() == 0 and valid_rows(validate_ranges(nan)).count() == 0


def test_override(cases):
    found = {r["name"]: r["e"] for r in cases.select("name", decisions.is_emergency().alias("e")).collect()}
    assert found == {"safe": False, "warning": False, "emergency": True, "bad seal": False, "bad power": False, "no seal": False}


def test_scores_without_models(cases):
    rows = cases.withColumns({
        "Predicted_Spoilage_Risk_Pct": F.lit(12.5), f"Probability_{EMERGENCY}": F.lit(0.9),
        f"Probability_{SAFE}": F.lit(0.04), f"Probability_{WARNING}": F.when(F.col("name") == "warning", 0.06).otherwise(0.05)})
    found = {r["name"]: r for r in scoring.score_shipments(rows, 0.06).collect()}
    # the emergency probability alone never makes an emergency
    assert found["safe"]["predicted_action"] == SAFE and found["safe"]["risk_level"] == "LOW"
    assert found["warning"]["predicted_action"] == WARNING and found["warning"]["risk_level"] == "MEDIUM"
    assert found["emergency"]["predicted_action"] == EMERGENCY and len(found["emergency"]["recommendations"]) == 4
    assert found["safe"]["confidence"] == 0.9 and found["safe"]["probabilities"][SAFE] == 0.04


def test_unknown_label(spark):
    row = spark.createDataFrame([("x",)], "a string").select(
        decisions.risk_level(F.col("a")).alias("l"), decisions.recommendations(F.col("a")).alias("r")).first()
    assert row["l"] == "UNKNOWN" and row["r"] == ["No recommendation available."]


def test_clip_keeps_null_and_nan(spark):
    rows = spark.createDataFrame([(None,), (float("nan"),), (-1.0,), (101.0,), (5.0,)], "x double")
    found = [r[0] for r in rows.select(clip("x", 0, 100)).collect()]
    assert found[0] is None and found[1] != found[1] and found[2:] == [0.0, 100.0, 5.0]


def test_half_even(spark):
    rows = spark.createDataFrame([(2.25,), (2.35,), (-0.125,)], "x double")
    assert [r[0] for r in rows.select(half_even(F.col("x"), 1)).collect()] == [2.2, 2.4, -0.1]


def test_edges_below_equals_counting(spark):
    edges = [0.1, 0.5, 0.5000001, 2.0, 7.0]
    values = [-1.0, 0.1, 0.3, 0.5, 0.5000001, 1.0, 2.0, 6.9, 7.0, 8.0, None]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    found = rows.select("x", edges_below(F.col("x"), edges).alias("below"), edges_below(F.col("x"), edges, True).alias("upto")).collect()
    for r in found:
        if r["x"] is None:
            assert r["below"] is None
        else:
            assert r["below"] == sum(e < r["x"] for e in edges) and r["upto"] == sum(e <= r["x"] for e in edges)


def test_features_at_zero_power_and_null(spark, cases):
    rows = cases.where("name = 'safe'").withColumn(WATTS, F.lit(0.0)).unionByName(cases.where("name = 'no seal'"))
    zero, gap = features_regression(rows).collect()
    assert zero["HVAC_Efficiency"] == 0.0 and zero["HVAC_Load_Per_Degree"] == 0.0
    assert gap["Seal_Loss_Score"] is None and gap["Thermal_Leak_Load"] is None and gap["Temperature_Deviation_C"] == 10.0
    assert features_staged(rows).first()["HVAC_Efficiency"] == 0.0


def test_requirements(spark, cases):
    with pytest.raises(ValueError, match="absent"):
        require_columns(cases, ["name", "absent"])
    with pytest.raises(ValueError):
        require_not_null(cases, "Seal_Integrity_Index")
    require_not_null(cases, WATTS)
    with pytest.raises(ValueError, match="Seal_Integrity_Index"):
        require_finite(cases, [WATTS, "Seal_Integrity_Index"])
    with pytest.raises(ValueError):
        apply_feature_selection(cases, ["absent"], "name")
    with pytest.raises(ValueError):
        require_class_counts(cases, {"safe": 2}, "name")
    require_class_counts(cases, {name: 1 for name, *_ in CASES}, "name")
