"""Exact quantiles by radix selection, linear in the rows for any number of distinct values.

Every double has a key, the bits of its number in order: keys of 64 bits sort as the values do. One scan counts readings
by the leading bits of their keys, for all columns, groups and quantiles together; a task's counts are combined before
the shuffle, so what moves is bounded by the cells and not by the values. Running counts over cells show which ones hold
a wanted rank. Only readings of those cells are counted by further bits in the next scan, until each wanted cell holds
one value: two scans for most tables, four at most. Values are never shuffled, nor sorted beyond the arrays of a task: without
groups, tasks count arrays of readings, column by column; with groups, readings are rows.
"""

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from frostline.operators.small import table_if_small
from frostline.workspace import fresh_path

#: Bits of the key below those that each scan counts by; the last one tells all values apart.
SHIFTS = (44, 28, 12, 0)
#: With no more readings than this in undecided cells, the next scan is the last.
FEW_ROWS = 1_000_000
#: Bits below the cells in which ranks are numbered: cells of the table, cells inside a cell.
_OUTER, _INNER = 44, 22
#: Readings of all columns that a task counts together.
_TOGETHER = 4_000_000
_SIZE_BITS = np.int64((1 << 63) - 1)


def _long(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(by, columns, "feature", "value")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def with_sort_key(df: DataFrame, value: str = "value", output: str = "key") -> DataFrame:
    """Add a bigint that sorts as the double `value`: the number's bits, negative for negative numbers.

    -0.0 and 0.0 have one key. `value` must not be null or NaN. Every step is exact: powers of two only move the point.
    """
    size, power, share = F.col("_size"), F.col("_power"), F.col("_share")
    infinite = size == F.lit(float("inf"))
    small = size < F.lit(2.0 ** -1022)  # numbers with fewer bits, zero among them
    scaled = df.withColumn("_size", F.abs(value)) \
        .withColumn("_power", F.when(infinite, 1024).when(small, -1023).otherwise(F.floor(F.log2(size)))) \
        .withColumn("_share", F.when(infinite, 1.0).when(small, size * F.lit(2.0 ** 537) * F.lit(2.0 ** 537) * F.lit(2.0 ** -52) + 1.0)
                    .otherwise(size * F.pow(F.lit(2.0), -power)))
    # The logarithm may be off by a rounding: a share belongs between 1 and 2.
    power = power + F.when(share < 1, -1).when(share >= 2, 1).otherwise(0)
    share = F.when(share < 1, share * 2).when(share >= 2, share / 2).otherwise(share)
    bits = (power + 1023) * F.lit(1 << 52) + ((share - 1) * F.lit(2.0 ** 52)).cast("bigint")
    return scaled.withColumn(output, F.when(F.col(value) < 0, -bits).otherwise(bits)).drop("_size", "_power", "_share")


def sort_keys(values: np.ndarray) -> np.ndarray:
    """The same key of each double of an array without NaN."""
    bits = np.ascontiguousarray(values, np.float64).view(np.int64)
    return np.where(bits < 0, -(bits & _SIZE_BITS), bits)


def _values_of(keys: np.ndarray) -> np.ndarray:
    """The doubles that have these keys; that of 0 has no sign."""
    return np.where(keys < 0, -np.abs(keys).view(np.float64), np.abs(keys).view(np.float64))


def value_counts(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows per distinct value of each numeric column; nulls and NaN are left out."""
    by = by or []
    value = (F.col("value") + F.lit(0.0)).alias("value")  # -0.0 counts as 0.0
    return _long(df, columns, by).groupBy(*by, "feature", value).agg(F.count("*").alias("n"))


def running_counts(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Add `before` (rows with a smaller value in the group) and `total` to distinct values and their counts.

    Values lie in cells of cells by their leading bits. Sums run over the values inside an inner cell, over the inner
    cells of an outer one and over the outer cells, so no task numbers a whole column, whatever its distribution.
    """
    keys = [*(by or []), "feature"]
    placed = with_sort_key(counts).withColumns({
        "_outer": F.shiftright("key", _OUTER), "_inner": F.shiftright("key", _INNER)})

    def before(inside: list[str], order: str) -> Column:
        earlier = Window.partitionBy(*inside).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(earlier), F.lit(0))

    inner = placed.groupBy(*keys, "_outer", "_inner").agg(F.sum("n").alias("n"))
    outer = inner.groupBy(*keys, "_outer").agg(F.sum("n").alias("n"))
    outer = outer.select(*keys, "_outer", before(keys, "_outer").alias("_start"), F.sum("n").over(Window.partitionBy(*keys)).alias("total"))
    inner = inner.withColumn("_inside", before([*keys, "_outer"], "_inner"))
    starts = _joined(inner.drop("n"), outer, [*keys, "_outer"]).select(*keys, "_inner", (F.col("_start") + F.col("_inside")).alias("_start"), "total")
    values = placed.withColumn("_inside", before([*keys, "_inner"], "key"))
    return _joined(values, starts, [*keys, "_inner"]).select(*keys, "value", "n", (F.col("_start") + F.col("_inside")).alias("before"), "total")


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Rows that agree in all of `on`, where null agrees with null."""
    right = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = reduce(Column.__and__, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_right_{c}`")) for c in on])
    return left.join(right, same, how).drop(*[f"_right_{c}" for c in on])


def _settled(cells: DataFrame) -> tuple[DataFrame, list[dict] | None, int]:
    """The cells, from memory or from a table in the shared folder when there are many; rows in undecided ones."""
    spark, small = cells.sparkSession, table_if_small(cells)
    if small is not None:
        rows = small.to_pylist()
        return spark.createDataFrame(small, cells.schema), rows, sum(r["n"] for r in rows if r["low"] < r["high"])
    path = fresh_path(spark, "cells")
    cells.write.parquet(path)
    stored = spark.read.schema(cells.schema).parquet(path)
    return stored, None, stored.agg(F.sum(F.when(F.col("low") < F.col("high"), F.col("n")))).first()[0] or 0


def _holding(ranks: Column) -> Column:
    """Those of the wanted ranks that a cell holds."""
    return F.filter(ranks, lambda t: (t["rank"] >= F.col("before")) & (t["rank"] < F.col("before") + F.col("n")))


def _counted(rows: DataFrame, by: list[str]) -> DataFrame:
    """Readings, smallest and largest value of each cell of a group, and those of earlier cells."""
    cells = rows.groupBy(*by, "cell").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    return _after_earlier(cells, by)


def _after_earlier(cells: DataFrame, by: list[str]) -> DataFrame:
    """Add the readings of earlier cells of a group."""
    earlier = Window.partitionBy(*by).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


#: The cells of a column to look into, in order, and their ids.
_Asked = tuple[np.ndarray, np.ndarray]


def _cells_of(values: np.ndarray, shift: int, asked: _Asked | None, asked_shift: int) -> tuple[np.ndarray, ...]:
    """Id of the cell asked for (0 where all are), cell, readings, smallest and largest value of the readings of a column."""
    keys = np.sort(sort_keys(values[~np.isnan(values)]))
    held = np.zeros(len(keys), np.int64)
    if asked is not None:
        cells, ids = asked
        outer = keys >> asked_shift
        place = np.minimum(np.searchsorted(cells, outer), len(cells) - 1)
        there = cells[place] == outer
        keys, held = keys[there], ids[place[there]]
    cell = keys >> shift
    first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])[:len(cell)])
    after = np.append(first[1:], len(cell))[:len(first)]
    return held[first], cell[first], after - first, _values_of(keys[first]), _values_of(keys[after - 1])


def _counted_columns(df: DataFrame, columns: list[str], shift: int, asked: list[dict] | None = None, asked_shift: int = 0) -> DataFrame:
    """As `_counted`, by `id`: the number of the column, or with cells to look into the id of such a cell."""
    inside: dict[int, _Asked | None] = dict.fromkeys(range(len(columns)))
    if asked is not None:
        inside = {}
        for i, c in enumerate(columns):
            mine = sorted((r["cell"], r["id"]) for r in asked if r["feature"] == c)
            if mine:
                inside[i] = tuple(np.array(x, np.int64) for x in zip(*mine))
    names, together = [f"c{i}" for i in inside], max(1, _TOGETHER // max(len(inside), 1))

    def counted(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        parts = []
        for name, (i, cells) in zip(names, inside.items()):
            values = np.concatenate([b.column(name).to_numpy(zero_copy_only=False).astype(np.float64, copy=False) for b in held])
            part = _cells_of(values, shift, cells, asked_shift)
            parts.append((np.full(len(part[0]), i), *part[1:]) if cells is None else part)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], ["id", "cell", "n", "low", "high"])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= together:
                yield counted(held)
                held = []
        if held:
            yield counted(held)

    rows = df.select(*[F.col(columns[i]).cast("double").alias(n) for i, n in zip(inside, names)])
    parts = rows.mapInArrow(made, "id bigint, cell bigint, n bigint, low double, high double")
    cells = parts.groupBy("id", "cell").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    return _after_earlier(cells, ["id"])


def _located(df: DataFrame, columns: list[str], probs: list[float], by: list[str]) -> tuple[DataFrame | None, list[tuple]]:
    """(*by, feature, total, value, at) for every wanted rank, where `at` numbers the ranks of the quantiles, two for
    each: those in a table, and those in memory.
    """
    keys = [*by, "feature"]
    keyed = with_sort_key(_long(df, columns, by))
    places = [f"named_struct('at', {2 * i + side}, 'rank', {part}((total - 1) * {p!r}D))" for i, p in enumerate(probs) for side, part in enumerate(("floor", "ceil"))]
    ranks = F.expr(f"array({', '.join(places)})")
    if by:
        cells = _counted(keyed.withColumn("cell", F.shiftright("key", SHIFTS[0])), keys)
    else:
        cells = _counted_columns(df, columns, SHIFTS[0]).withColumn("feature", F.get(F.lit(columns), F.col("id").cast("int")))
    cells = cells.withColumn("total", F.sum("n").over(Window.partitionBy(*keys))).withColumn("ranks", _holding(ranks))
    found, known, shift = None, [], SHIFTS[0]
    while True:
        chosen = cells.where(F.size("ranks") > 0).select(
            *keys, "cell", "n", "low", "high", "before", "total", "ranks", F.monotonically_increasing_id().alias("id"))
        cells, rows, undecided = _settled(chosen)
        if rows is None:
            more = cells.where("low = high").select(*keys, "total", F.col("low").alias("value"), F.explode("ranks.at").alias("at"))
            found = more if found is None else found.unionByName(more)
        else:
            known += [(*(r[k] for k in keys), r["total"], r["low"], t["at"]) for r in rows if r["low"] == r["high"] for t in r["ranks"]]
        if not undecided:
            return found, known
        inner = cells.where("low < high").select(*keys, "cell", "id", F.col("before").alias("start"), "total", "ranks")
        last, shift = shift, 0 if undecided <= FEW_ROWS else next(s for s in SHIFTS if s < shift)
        if by or rows is None:
            asked = _joined(keyed.withColumn("cell", F.shiftright("key", last)), inner.select(*keys, "cell", "id"), [*keys, "cell"])
            inside = _counted(asked.withColumn("cell", F.shiftright("key", shift)), ["id"])
        else:
            inside = _counted_columns(df, columns, shift, [r for r in rows if r["low"] < r["high"]], last)
        cells = inside.join(inner.drop("cell"), "id").withColumn("before", F.col("start") + F.col("before")).withColumn("ranks", _holding(F.col("ranks")))


def _between(lo: float, hi: float, place: float) -> float:
    """The value at a place between two ranks; equal infinities have no difference."""
    return lo + 0.0 if lo == hi else lo + (hi - lo) * (place - math.floor(place))


def _interpolated(known: list[tuple], probs: list[float]) -> list[tuple]:
    """(*by, feature, q0, ...) for every group whose ranks are in memory."""
    groups: dict[tuple, dict[int, float]] = {}
    for *key, value, at in known:
        groups.setdefault(tuple(key), {})[at] = value
    return [(*key, *(_between(ends[2 * i], ends[2 * i + 1], (total - 1) * p) for i, p in enumerate(probs)))
            for (*key, total), ends in groups.items()]


def _interpolated_table(found: DataFrame, probs: list[float], keys: list[str]) -> DataFrame:
    """The same for ranks in a table."""
    ends = [F.max(F.when(F.col("at") == 2 * i + side, F.col("value"))).alias(f"{name}{i}")
            for i in range(len(probs)) for side, name in enumerate(("lo", "hi"))]
    outputs = []
    for i, p in enumerate(probs):
        place, lo, hi = (F.col("total") - 1) * F.lit(float(p)), F.col(f"lo{i}"), F.col(f"hi{i}")
        outputs.append(F.when(lo == hi, lo + 0.0).otherwise(lo + (hi - lo) * (place - F.floor(place))).alias(f"q{i}"))
    return found.groupBy(*keys, "total").agg(*ends).select(*keys, *outputs)


def quantiles(df: DataFrame, columns: list[str], probs: list[float], by: list[str] | None = None,
              accuracy: int | None = None) -> DataFrame:
    """Linear-interpolated exact quantiles `q0..` of each column, per group; a null group is a group.

    The scans run when this is called. With `accuracy` a sketch is the answer (rank error 1 / accuracy).
    """
    by = by or []
    keys = [*by, "feature"]

    if accuracy is not None:
        sketch = _long(df, columns, by).groupBy(*keys).agg(F.percentile_approx("value", probs, accuracy).alias("q"))
        return sketch.select(*keys, *[F.col("q")[i].alias(f"q{i}") for i in range(len(probs))])
    found, known = _located(df, columns, [float(p) for p in probs], by)
    groups = [StructField(c, df.schema[c].dataType) for c in by]
    if found is None:
        names = [StructField(f"q{i}", DoubleType()) for i in range(len(probs))]
        return df.sparkSession.createDataFrame(_interpolated(known, probs), StructType([*groups, StructField("feature", StringType()), *names]))
    kind = StructType([*groups, *StructType.fromDDL("feature string, total bigint, value double, at int")])
    return _interpolated_table(found.unionByName(df.sparkSession.createDataFrame(known, kind)), probs, keys)
