"""Synthetic rows obey their limits, repeat exactly and survive any partitioning."""

import pytest
from pyspark.sql import functions as F

from frostline.operators import synthesis as ops
from frostline.operators.contracts import class_counts, filter_class
from frostline.schema import (
    ACTION, ACTUAL, AMBIENT, EMERGENCY, ID, NUMERIC, ORIGIN, RISK, SAFE, SEAL, SET_POINT, WARNING, WATTS,
)


@pytest.fixture(scope="module")
def balanced(readings):
    return ops.balance_classes(readings, {SAFE: 600, WARNING: 300, EMERGENCY: 400}).cache()


def test_counts_ids_and_origin(balanced):
    assert class_counts(balanced, [SAFE, WARNING, EMERGENCY]) == {SAFE: 600, WARNING: 300, EMERGENCY: 400}
    assert balanced.select(ID).distinct().count() == 1300
    origins = {r[ORIGIN]: r["count"] for r in balanced.groupBy(ORIGIN).count().collect()}
    assert origins["synthetic_emergency"] == 400 and origins["real"] + origins["synthetic_warning"] == 900


def test_limits(balanced):
    warning = balanced.where(F.col(ORIGIN) == "synthetic_warning")
    assert warning.where(~F.col(SEAL).between(0.70, 1.0) | (F.col(WATTS) < 100) | ~F.col(RISK).between(20, 70)
                         | (F.col(ACTUAL) < F.col(SET_POINT) - 1.0)).count() == 0
    emergency = balanced.where(F.col(ORIGIN) == "synthetic_emergency")
    assert emergency.where(~F.col(SEAL).between(0.10, 0.70) | (F.col(WATTS) < 0) | ~F.col(RISK).between(70, 100)
                           | (F.col(ACTUAL) < F.col(SET_POINT) + 5.0)).count() == 0


def test_same_rows_for_any_partitioning(readings):
    targets = {SAFE: 500, WARNING: 100, EMERGENCY: 100}
    for method in ("physics", "staged", "bands"):
        a = ops.balance_classes(readings.coalesce(1), targets, method)
        b = ops.balance_classes(readings.repartition(8), targets, method)
        keys = [ID, ACTION, ORIGIN, *[F.round(c, 6).alias(c) for c in NUMERIC]]
        assert a.select(keys).exceptAll(b.select(keys)).count() == 0 and a.count() == 700


def test_errors(readings):
    with pytest.raises(ValueError, match="SAFE"):
        ops.balance_classes(readings, {SAFE: 10**6, WARNING: 100, EMERGENCY: 1})
    with pytest.raises(ValueError, match="exceed"):
        ops.balance_classes(readings, {SAFE: 10, WARNING: 1, EMERGENCY: 1})
    with pytest.raises(ValueError, match="WARNING"):
        ops.balance_classes(filter_class(readings, SAFE), {SAFE: 10, WARNING: 1, EMERGENCY: 1})


def test_scenario_shares(spark):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias(ID))
    found = {r["scenario"]: r["count"] / 20_000 for r in ops.draw_scenario(rows, ID).groupBy("scenario").count().collect()}
    assert sum(ops.SCENARIO_WEIGHTS.values()) == pytest.approx(1.0)
    for name, weight in ops.SCENARIO_WEIGHTS.items():
        assert found[name] == pytest.approx(weight, abs=0.015)


@pytest.mark.parametrize("kind,low,high", [("warning", 2, 5), ("emergency", 6, 12)])
def test_bands(readings, kind, low, high):
    made = ops.scenario_bands(readings, kind)
    bands = ops.BANDS[kind]
    for c in (AMBIENT, WATTS, SEAL, RISK):
        lo, hi = made.agg(F.min(c), F.max(c)).first()
        assert bands[c][0] <= lo and hi <= bands[c][1]
    deviation = F.col(ACTUAL) - F.col(SET_POINT)
    lo, hi = made.agg(F.min(deviation), F.max(deviation)).first()
    assert low - 0.06 <= lo and hi <= high + 0.06
    assert made.where(F.round(AMBIENT, 1) != F.col(AMBIENT)).count() == 0


def test_single_seed_keeps_its_values(readings):
    """With one warning row there is no deviation, so noise leaves it unchanged before the limits."""
    one = filter_class(readings, WARNING).orderBy(ID).limit(1)
    made = ops.synth_warning(one, ops.fit_profiles(one, (WARNING,)), ID)
    assert made.select(NUMERIC).first() == one.select(NUMERIC).first()


def test_staged_bounds(readings):
    seeds = filter_class(readings, WARNING)
    free = ops.scenario_staged(seeds)
    held = ops.scenario_staged(seeds, bounds=seeds)
    top = seeds.agg(F.max(ACTUAL)).first()[0]
    assert free.agg(F.max(ACTUAL)).first()[0] > top
    assert held.agg(F.max(ACTUAL)).first()[0] <= top


def test_next_ids(spark):
    old = spark.createDataFrame([("COLD_CNT_000009",), ("COLD_CNT_000041",), ("none",)], f"{ID} string")
    new = spark.range(2).withColumnRenamed("id", "draw_id")
    assert sorted(r[ID] for r in ops.next_ids(old, new).collect()) == ["COLD_CNT_000042", "COLD_CNT_000043"]
    assert ops.next_ids(old.limit(0), new).orderBy("draw_id").first()[ID] == "COLD_CNT_000001"
