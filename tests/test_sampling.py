"""Splits and samples against brute force, for any partitioning and through every code path."""

import hashlib

import pytest
from pyspark.sql import functions as F

from frostline.operators import sampling
from frostline.schema import ACTION, ID, RISK


def _order(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{k}:{seed}:order".encode()).hexdigest(), k))


def _skewed(spark, partitions):
    rows = spark.range(4000).select(
        F.format_string("K%05d", "id").alias(ID), F.when(F.col("id") < 9, F.lit("rare")).when(F.col("id") < 10, None).otherwise("hot").alias("c"))
    return rows.repartition(partitions)


def _splits(df):
    return {r[ID]: r["split"] for r in df.collect()}


@pytest.mark.parametrize("partitions", [1, 8])
def test_split_equals_brute_force(spark, partitions):
    rows = _skewed(spark, partitions)
    shares = {"train": 0.7, "validation": 0.15, "test": 0.15}
    found = _splits(sampling.stratified_split(rows, "c", shares))
    groups = {}
    for r in rows.collect():
        groups.setdefault(r["c"], []).append(r[ID])
    for keys in groups.values():
        a, b = round(len(keys) * 0.7), round(len(keys) * 0.85)
        expected = {k: "train" if i < a else "validation" if i < b else "test" for i, k in enumerate(_order(keys))}
        assert {k: found[k] for k in keys} == expected


@pytest.mark.parametrize("setting,value", [("RANKED_ROWS", 1), ("STRATA_LIMIT", 1)])
def test_other_paths_give_the_same_split(spark, monkeypatch, setting, value):
    rows = _skewed(spark, 4)
    plain = _splits(sampling.stratified_split(rows, "c"))
    monkeypatch.setattr(sampling, setting, value)
    assert _splits(sampling.stratified_split(rows, "c")) == plain


def test_reference_counts(spark):
    """79,808 / 192 rows in 70/15/15."""
    rows = spark.range(80_000).select(
        F.col("id").cast("string").alias(ID), F.when(F.col("id") < 192, F.lit("W")).otherwise("S").alias("c"))
    split = sampling.stratified_split(rows, "c", {"train": 0.7, "validation": 0.15, "test": 0.15})
    found = {(r["split"], r["c"]): r["count"] for r in split.groupBy("split", "c").count().collect()}
    assert found == {("train", "S"): 55_866, ("train", "W"): 134, ("validation", "S"): 11_971, ("validation", "W"): 29,
                     ("test", "S"): 11_971, ("test", "W"): 29}
    report = {(r["split"], r["class"]): r["percentage"] for r in sampling.split_report(split, "c").collect()}
    assert report[("original", "S")] == 99.76 and report[("test", "W")] == 0.24


def test_sample_n_and_numbers(spark):
    rows = _skewed(spark, 3)
    keys = _order([r[ID] for r in rows.collect()])
    assert {r[ID] for r in sampling.sample_n(rows, 700).collect()} == set(keys[:700])
    numbered = sampling.number_rows(rows).collect()
    assert {r[ID]: r["row_no"] for r in numbered} == {k: i for i, k in enumerate(keys)}
    assert sampling.sample_n(rows, 4000).count() == 4000
    assert sampling.sample_n(rows, 0).count() == 0
    with pytest.raises(ValueError):
        sampling.sample_n(rows, 4001)


def test_replacement_draws(spark):
    seeds = _skewed(spark, 2).where("c = 'rare'")
    drawn = sampling.sample_with_replacement(seeds, 5000)
    counts = {r[ID]: r["count"] for r in drawn.groupBy(ID).count().collect()}
    assert sum(counts.values()) == 5000 and len(counts) == 9 and min(counts.values()) > 400
    assert sampling.sample_with_replacement(seeds.limit(0), 10).count() == 0


def test_shuffle_keeps_rows(spark, readings):
    shuffled = sampling.shuffle_rows(readings)
    assert shuffled.drop("shuffle_key").exceptAll(readings).count() == 0
    assert [r[ID] for r in shuffled.limit(50).collect()] != [r[ID] for r in readings.orderBy(ID).limit(50).collect()]


def test_strata(spark, readings):
    marked = sampling.quantile_strata(readings, RISK)
    sizes = [r["count"] for r in marked.groupBy("stratum").count().collect()]
    assert len(sizes) == 10 and sum(sizes) == readings.count() and max(sizes) - min(sizes) <= 10
    flat = readings.withColumn(RISK, F.lit(1.0))
    with pytest.raises(ValueError):
        sampling.quantile_strata(flat, RISK)
    with pytest.raises(ValueError):
        sampling.quantile_strata(readings.limit(0), RISK)


def test_regression_split_is_a_partition(readings):
    split = sampling.regression_split(readings.select(ID, RISK, ACTION), RISK)
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert split.select(ID).distinct().count() == readings.count() == sum(sizes.values())
    assert abs(sizes["test"] - 150) <= 10 and abs(sizes["validation"] - 150) <= 10


def _repeating(spark, nulls):
    """1,000 rows of 20 ids, a tenth of them missing if asked; every row of id 7 is the same."""
    rows = [(None if nulls and i % 10 == 3 else f"c{i % 20}", float(0 if i % 20 == 7 else i), "ab"[i % 3 == 0]) for i in range(1000)]
    return spark.createDataFrame(rows, "Container_ID string, risk double, kind string").repartition(5)


@pytest.mark.parametrize("nulls", [False, True])
def test_repeated_keys_split_exactly(spark, nulls):
    rows = _repeating(spark, nulls)
    for n in (1, 110, 500, 990, 1000):
        assert sampling.sample_n(rows, n).count() == n
    shares = {"x": 0.33, "y": 0.33, "z": 0.34}
    marked = sampling.stratified_split(rows, "kind", shares).groupBy("kind", "split").count().collect()
    total = {"a": 666, "b": 334}
    for r in marked:
        ends = [0, round(total[r.kind] * 0.33), round(total[r.kind] * 0.66), total[r.kind]]
        place = "xyz".index(r["split"])
        assert r["count"] == ends[place + 1] - ends[place]
    numbered = sampling.number_rows(rows).collect()
    assert sorted(r.row_no for r in numbered) == list(range(1000))
    drawn = sampling.sample_with_replacement(rows, 400)
    assert drawn.count() == 400 and drawn.select("draw_id").distinct().count() == 400


def test_repeated_keys_split_alike_in_any_partitioning(spark):
    rows = _repeating(spark, True)
    key = lambda r: str(r)
    first = sorted(sampling.sample_n(rows, 333).collect(), key=key)
    assert first == sorted(sampling.sample_n(rows.repartition(3, "risk"), 333).collect(), key=key)


def test_prefixes_follow_the_rows():
    assert [sampling.prefix_digits(n) for n in (0, 10**6, 10**9, 10**12)] == [2, 2, 4, 6]
