"""Profiles of a table: counts, moments, quantiles, correlations, outliers, information."""

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from frostline.functions.numeric import edges_below, finite, half_even, rounded
from frostline.operators.contracts import null_counts, stack_columns
from frostline.operators.quantiles import quantiles, running_counts, value_counts
from frostline.operators.small import with_totals
from frostline.schema import ACTION, NUMERIC, RISK, SAFE, WARNING
from frostline.workspace import fresh_path, remove

# Bin edges of the target report.
TARGET_EDGES = [0, 10, 20, 30, 40, 50, 60, 70, 80, 90, 100]
LEAKAGE = [RISK]


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows equal to an earlier row on all columns.

    Rows are counted by two 64-bit hashes of all columns, so their bytes don't travel; nulls are values like others.
    """
    value = {c: F.col(f"`{c}`") + 0.0 if t in ("double", "float") else F.col(f"`{c}`") for c, t in df.dtypes}  # -0.0 equals 0.0
    marked = [x for v in value.values() for x in (v, v.isNull())]
    groups = df.groupBy(F.xxhash64(*marked).alias("a"), F.xxhash64(F.lit(1), *marked).alias("b")).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def missing_values(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls per column and in total; the total is the sum over one row per column."""
    per_column = null_counts(df, columns or df.columns)
    total = per_column.agg(F.sum("nulls").alias("nulls")).select(F.lit("(total)").alias("column"), "nulls")
    return per_column.unionByName(total)


def dataset_overview(df: DataFrame) -> DataFrame:
    """Rows, columns, duplicates, and nulls and type of each column: one scan for counts, one for duplicates."""
    kind = "metric string, column string, value string"
    known = [("columns", "", str(len(df.columns))), *(("type", c, t) for c, t in df.dtypes)]
    fixed = df.sparkSession.createDataFrame(known, kind)
    wide = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    entries = [F.struct(F.lit("rows").alias("metric"), F.lit("").alias("column"), F.col("rows").cast("string").alias("value"))]
    entries += [F.struct(F.lit("missing").alias("metric"), F.lit(c).alias("column"), F.col(f"n{i}").cast("string").alias("value"))
                for i, c in enumerate(df.columns)]
    duplicates = duplicate_count(df).select(F.lit("duplicate_rows").alias("metric"), F.lit("").alias("column"), F.col("duplicate_rows").cast("string").alias("value"))
    return wide.select(F.inline(F.array(*entries))).unionByName(fixed).unionByName(duplicates)


def class_distribution(df: DataFrame, column: str = ACTION) -> DataFrame:
    """Rows and share of each class, largest first."""
    counts = df.groupBy(F.col(column).alias("class")).agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy())  # one row per class
    return counts.select("class", "count", (F.col("count") / total * 100.0).alias("percentage")).orderBy(F.desc("count"), "class")


def moments(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Count, mean, std, min and max of every column, one scan."""
    names = ["count", "mean", "std", "min", "max"]
    aggregates = [
        agg.alias(f"{c}|{s}") for c in columns for s, agg in zip(names, (
            F.count(finite(c)), F.avg(finite(c)), F.stddev(finite(c)), F.min(finite(c)), F.max(finite(c))))]
    wide = df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)
    return stack_columns(wide, columns, names, "feature", by)


def _describe(df: DataFrame, columns: list[str], percentiles: list[int], by: list[str] | None) -> DataFrame:
    keys = [*(by or []), "feature"]
    marks = quantiles(df, columns, [p / 100 for p in percentiles], by)
    marks = marks.withColumnsRenamed({f"q{i}": f"p{p}" for i, p in enumerate(percentiles)})
    return moments(df, columns, by).join(marks, keys, "left")


def numerical_statistics(df: DataFrame, columns: list[str] = NUMERIC,
                         percentiles: tuple[int, ...] = (5, 25, 50, 75, 95)) -> DataFrame:
    return _describe(df, columns, list(percentiles), None)


def classwise_statistics(df: DataFrame, by: str = ACTION, columns: list[str] = NUMERIC) -> DataFrame:
    return _describe(df, columns, [25, 50, 75], [by])


def string_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("count"))


def categorical_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per value of each string column."""
    return string_counts(df, columns)


def statistical_summary(df: DataFrame, numeric: list[str], strings: list[str]) -> DataFrame:
    """Describe all columns: unique/top/freq for strings (smallest value on ties), moments and quartiles for numbers."""
    numbers = _describe(df, numeric, [25, 50, 75], None)
    best = F.min_by(F.struct("value", "count"), F.struct(-F.col("count"), F.col("value")))
    texts = (
        string_counts(df, strings).groupBy(F.col("column").alias("feature"))
        .agg(F.sum("count").alias("count"), F.count("*").alias("unique"), best.alias("best"))
        .select("feature", "count", "unique", F.col("best.value").alias("top"), F.col("best.count").alias("freq"))
    )
    return numbers.unionByName(texts, allowMissingColumns=True)


def _pairs(columns: list[str]) -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]


def _correlation_long(wide: DataFrame, columns: list[str], digits: int | None) -> DataFrame:
    """Both triangles and the diagonal, as rows with the positions of the two columns (k * k numbers)."""
    found = wide.first()
    entries = []
    for i, j in _pairs(columns):
        for a, b in sorted({(i, j), (j, i)}):
            entries.append((columns[a], columns[b], a, b, found[f"{i}|{j}"]))
    schema = "feature_1 string, feature_2 string, position_1 int, position_2 int, correlation double"
    matrix = wide.sparkSession.createDataFrame(entries, schema)
    return matrix if digits is None else matrix.withColumn("correlation", rounded("correlation", digits))


def _correlations(df: DataFrame, columns: list[str], rows: int, centres: dict[str, tuple]) -> DataFrame:
    """All pairs in one aggregate, as sums of products of standardised columns.

    `centres` holds (mean, population std, rows with a value) of each column. A pair with a
    partly missing column is correlated over the rows that have both.
    """
    standard = {c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s, n) in centres.items() if n == rows and s}
    aggregates = []
    for i, j in _pairs(columns):
        a, b = columns[i], columns[j]
        if not rows or not centres[a][1] or not centres[b][1]:
            value = F.max(F.lit(None).cast("double"))
        elif i == j:
            value = F.max(F.lit(1.0))
        elif a in standard and b in standard:
            value = F.sum(standard[a] * standard[b]) / F.lit(float(rows))
        else:
            value = F.corr(a, b)
        aggregates.append(value.alias(f"{i}|{j}"))
    return df.agg(*aggregates)


def pearson_matrix(df: DataFrame, columns: list[str] = NUMERIC, digits: int | None = None) -> DataFrame:
    """Correlation of all pairs: one scan for the means (one row to the driver), one for the products."""
    numbers = df.select(*[finite(c).alias(c) for c in columns])
    first = numbers.agg(F.count("*").alias("rows"), *[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"), F.count(c).alias("n")).alias(c) for c in columns]).first()
    centres = {c: (first[c]["mean"], first[c]["std"], first[c]["n"]) for c in columns}
    return _correlation_long(_correlations(numbers, columns, first["rows"], centres), columns, digits)


def spearman_matrix(df: DataFrame, columns: list[str] = NUMERIC, digits: int | None = None) -> DataFrame:
    """Pearson correlation of average ranks.

    A value's rank follows from the distinct-value counts, so rows are never sorted. The rank
    tables are written and read back: Spark then knows their size and broadcasts a table only
    when it is small; otherwise rows meet it in a shuffled join whose hot values AQE splits.
    Rows with a missing value are left out.
    """
    spark = df.sparkSession
    complete = df.select(*[finite(c).alias(c) for c in columns]).na.drop()
    path = fresh_path(spark, "ranks")
    running_counts(value_counts(complete, columns)).select(
        "feature", "value", "n", "total", (F.col("before") + (F.col("n") + 1) / 2.0).alias("rank")
    ).write.partitionBy("feature").parquet(path)  # one folder per column name
    ranks = spark.read.schema("feature string, value double, n bigint, total bigint, rank double").parquet(path)
    middle = (F.col("total") + 1) / 2.0
    spread = F.sqrt(F.sum(F.col("n") * (F.col("rank") - middle) * (F.col("rank") - middle)) / F.max("total"))
    known = {  # one row per column name
        r["feature"]: r for r in ranks.groupBy("feature").agg(
            F.max("total").alias("rows"), F.max(middle).alias("mean"), spread.alias("std")).collect()}
    rows = max((r["rows"] for r in known.values()), default=0)
    ranked, centres = complete, {}
    for c in columns:
        centres[c] = (known[c]["mean"], known[c]["std"], rows) if c in known else (None, None, 0)
        table = ranks.where(F.col("feature") == c).select(F.col("value").alias(c), F.col("rank").alias("_rank"))
        ranked = ranked.join(table, c).drop(c).withColumnRenamed("_rank", c)
    matrix = _correlation_long(_correlations(ranked, columns, rows, centres), columns, digits)  # k * k numbers, found here
    remove(spark, path)
    return matrix


def top_correlations(matrix: DataFrame, n: int = 10) -> DataFrame:
    """Largest absolute correlations, one row per distinct value (the diagonal gives one row)."""
    strength = matrix.withColumn("strength", F.abs("correlation"))
    first = F.row_number().over(Window.partitionBy("strength").orderBy("position_1", "position_2"))
    return (
        strength.withColumn("place", first).where("place = 1")
        .orderBy(F.desc("strength"), "position_1", "position_2").limit(n)
        .select("feature_1", "feature_2", "strength")
    )


def class_mean_comparison(df: DataFrame, first: str = SAFE, second: str = WARNING, columns: list[str] = NUMERIC,
                          by: str = ACTION) -> DataFrame:
    """Mean of each column in two named classes and their difference; empty when a class is absent."""
    wide = df.agg(*[
        agg.alias(f"{c}|{s}") for c in columns for s, agg in (
            ("first_mean", F.avg(F.when(F.col(by) == first, finite(c)))),
            ("second_mean", F.avg(F.when(F.col(by) == second, finite(c)))))],
        F.count_if(F.col(by) == first).alias("_n1"), F.count_if(F.col(by) == second).alias("_n2"))
    present = wide.where("_n1 > 0 AND _n2 > 0")
    means = stack_columns(present, columns, ["first_mean", "second_mean"], "feature")
    return means.withColumn("difference", F.col("second_mean") - F.col("first_mean"))


def _fences(df: DataFrame, columns: list[str], k: float) -> dict[str, tuple]:
    """Quartiles and fences (q1, median, q3, lower, upper) of each column: one row per column to the driver."""
    found = {}
    for r in quantiles(df, columns, [0.25, 0.5, 0.75]).collect():
        iqr = r["q2"] - r["q0"]
        found[r["feature"]] = (r["q0"], r["q1"], r["q2"], r["q0"] - k * iqr, r["q2"] + k * iqr)
    return found


def iqr_outliers(df: DataFrame, columns: list[str] = NUMERIC, k: float = 1.5) -> DataFrame:
    """Quartiles and rows outside the fences; the share is of all rows. One aggregate after the quantiles."""
    fences = _fences(df, columns, k)
    known = [c for c in columns if c in fences]
    outside = {c: (finite(c) < F.lit(fences[c][3])) | (finite(c) > F.lit(fences[c][4])) for c in known}
    wide = df.agg(F.count("*").alias("_rows"), *[F.count_if(outside[c]).alias(f"{c}|outlier_count") for c in known])
    bounds = [(c, fences[c][0], fences[c][2], fences[c][2] - fences[c][0]) for c in known]
    quartiles = df.sparkSession.createDataFrame(bounds, "feature string, q1 double, q3 double, iqr double")
    counted = stack_columns(wide, known, ["outlier_count"], "feature", ["_rows"]) if known else None
    if counted is None:
        return quartiles.selectExpr("*", "0L AS outlier_count", "0D AS outlier_percentage")
    share = half_even(F.col("outlier_count") / F.col("_rows") * 100.0, 2)
    return quartiles.join(counted, "feature").withColumn("outlier_percentage", share).drop("_rows")


def boxplot_stats(df: DataFrame, columns: list[str] = NUMERIC, k: float = 1.5) -> DataFrame:
    """Quartiles, the furthest readings inside the fences, and the rows beyond them."""
    fences = _fences(df, columns, k)
    known = [c for c in columns if c in fences]
    aggregates = []
    for c in known:
        inside = finite(c).between(fences[c][3], fences[c][4])
        aggregates += [
            F.min(F.when(inside, F.col(c))).alias(f"{c}|whisker_low"), F.max(F.when(inside, F.col(c))).alias(f"{c}|whisker_high"),
            F.count_if(~inside).alias(f"{c}|fliers")]
    quartiles = df.sparkSession.createDataFrame(
        [(c, *fences[c][:3]) for c in known], "feature string, q1 double, median double, q3 double")
    if not known:
        return quartiles.selectExpr("*", "0D AS whisker_low", "0D AS whisker_high", "0L AS fliers")
    return quartiles.join(stack_columns(df.agg(*aggregates), known, ["whisker_low", "whisker_high", "fliers"], "feature"), "feature")


def target_summary(df: DataFrame, column: str = RISK) -> DataFrame:
    """Describe plus skewness and excess kurtosis (population), 4 digits."""
    shape = df.agg(F.skewness(finite(column)).alias("skewness"), F.kurtosis(finite(column)).alias("kurtosis"))
    described = _describe(df, [column], [25, 50, 75], None)
    return with_totals(described, shape).withColumns({
        "skewness": half_even(F.col("skewness"), 4) + F.lit(0.0), "kurtosis": half_even(F.col("kurtosis"), 4) + F.lit(0.0)})


def binned_distribution(df: DataFrame, column: str = RISK, edges: list[float] = TARGET_EDGES) -> DataFrame:
    """Rows per right-closed bin, lowest edge included; empty bins stay, values outside are left out."""
    spark = df.sparkSession
    bins = spark.createDataFrame(
        [(i, f"{lo}-{hi}") for i, (lo, hi) in enumerate(zip(edges, edges[1:]))], "bin int, label string")
    value = F.col(column)
    bin_no = F
    for i, hi in enumerate(edges[1:]):
        bin_no = bin_no.when(value <= F.lit(float(hi)), F.lit(i))
    counted = (
        df.where(value.between(float(edges[0]), float(edges[-1])))
        .select(bin_no.alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    )
    return bins.join(counted, "bin", "left").select("bin", "label", F.coalesce("n", F.lit(0)).alias("count")).orderBy("bin")


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Rows per equal-width bin between minimum and maximum; the last bin holds the maximum."""
    value = finite(column)
    span = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    place = F.floor((value - F.col("lo")) / F.nullif(width, F.lit(0.0)))
    bin_no = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    counted = with_totals(df.where(value.isNotNull()), span).groupBy(bin_no.alias("bin")).agg(F.count("*").alias("n"))
    all_bins = span.where("lo IS NOT NULL").select(
        "lo", width.alias("width"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return all_bins.join(counted, "bin", "left").select(
        "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_low"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("count"))


def density_curve(df: DataFrame, column: str, points: int = 200, cut: float = 3.0) -> DataFrame:
    """A smooth density (normal kernel, Scott's width) on equally spaced points, as (point, value, density).

    One scan shares every reading between the two points around it; the kernel is summed over points, not readings. The
    curve goes `cut` widths beyond the smallest and the largest value. No rows when all values are equal or missing.
    """
    value, schema = finite(column), "point int, value double, density double"
    finite_value = F.when(F.abs(value) < float("inf"), value)
    known = df.agg(F.count(finite_value).alias("n"), F.stddev(finite_value).alias("std"), F.min(finite_value).alias("lo"), F.max(finite_value).alias("hi")).first()
    if not known["std"]:
        return df.sparkSession.createDataFrame([], schema)
    width = known["std"] * known["n"] ** -0.2
    lowest = known["lo"] - cut * width
    step = (known["hi"] + cut * width - lowest) / (points - 1)
    place = (finite_value - F.lit(lowest)) / F.lit(step)
    shared = df.select(place.alias("place")).where("place IS NOT NULL").select(F.floor("place").alias("at"), (F.col("place") - F.floor("place")).alias("part"))
    held = np.zeros(points + 1)
    for r in shared.groupBy("at").agg(F.sum(1.0 - F.col("part")).alias("here"), F.sum("part").alias("next")).collect():  # one row a point
        held[r["at"]] += r["here"]
        held[r["at"] + 1] += r["next"]
    grid = lowest + step * np.arange(points)
    kernel = np.exp(-0.5 * ((grid[:, None] - grid) / width) ** 2) / (known["n"] * width * math.sqrt(2.0 * math.pi))
    rows = [(i, float(g), float(d)) for i, (g, d) in enumerate(zip(grid, kernel @ held[:points]))]
    return df.sparkSession.createDataFrame(rows, schema)


def digamma(x: Column) -> Column:
    """The digamma function for x of 1 or more: six steps up, then its asymptotic series (error below 1e-10)."""
    y = x + F.lit(6.0)
    square = F.lit(1.0) / (y * y)
    series = square * (F.lit(1 / 12) - square * (F.lit(1 / 120) - square * (F.lit(1 / 252) - square * (F.lit(1 / 240) - square * F.lit(1 / 132)))))
    return F.ln(y) - F.lit(0.5) / y - series - sum((F.lit(1.0) / (x + F.lit(float(i))) for i in range(1, 6)), F.lit(1.0) / x)


def neighbour_information(df: DataFrame, columns: list[str], target: str = ACTION, k: int = 3) -> DataFrame:
    """Information (nats) between each column and a class from nearest neighbours, without bins.

    For every reading the distance to its k-th neighbour of the same class is taken, and the readings of any class that
    are nearer are counted; the mean digamma of those counts tells the information (Ross 2014). Classes of one reading
    are left out, smaller ones than k + 1 look at all their others. Null, NaN and infinities are left out.

    Equal readings are counted once. A value's neighbours are those up to k ranks away in its class; ranks and counts
    below a number come from cells of values, so no class, however large, is put in order in one task.
    """
    numbers = df.select(F.col(target).cast("string").alias("class"), *[F.when(F.abs(finite(c)) < float("inf"), finite(c)).alias(c) for c in columns])
    paths = [fresh_path(df.sparkSession, name) for name in ("values", "reach")]
    value_counts(numbers.where(F.col("class").isNotNull()), columns, ["class"]).write.parquet(paths[0])
    counts = df.sparkSession.read.parquet(paths[0])
    sizes = counts.groupBy("class", "feature").agg(F.sum("n").alias("in_class")).where("in_class > 1")
    counts = counts.join(sizes, ["class", "feature"])
    ranks = running_counts(counts.select("class", "feature", "value", F.lit(1).cast("bigint").alias("n")), ["class"]).select(
        "class", "feature", "value", F.col("before").alias("rank"))
    ranked = counts.join(ranks, ["class", "feature", "value"])
    near = ranked.select("class", "feature", "in_class", "value", "n", F.explode(F.sequence(F.col("rank") - k, F.col("rank") + k)).alias("rank"), F.col("rank").alias("own"))
    around = near.groupBy("class", "feature", "rank").agg(
        F.max(F.when(F.col("own") == F.col("rank"), F.struct("value", "n", "in_class"))).alias("me"),
        F.collect_list(F.struct("value", "n")).alias("others")).where("me IS NOT NULL")  # at most 2k + 1
    wanted = F.least(F.lit(k), F.col("me.in_class") - 1)
    distances = F.array_sort(F.transform("others", lambda o: F.struct(
        F.abs(o["value"] - F.col("me.value")).alias("far"), F.when(o["value"] == F.col("me.value"), o["n"] - 1).otherwise(o["n"]).alias("n"))))
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("double").alias("far"))
    radius = F.aggregate(distances, start, lambda a, o: F.when(
        a["seen"] >= wanted, a).otherwise(F.struct((a["seen"] + o["n"]).alias("seen"), o["far"].alias("far"))))["far"]
    # A little less than the radius, so that the k-th neighbour itself isn't counted.
    reach = around.select("class", "feature", F.col("me.value").alias("value"), F.col("me.n").alias("n"), F.col("me.in_class").alias("in_class"),
                          wanted.alias("k"), (radius * F.lit(1.0 - 1e-9)).alias("reach"))
    reach = reach.withColumns({"low": F.col("value") - F.col("reach") + 0.0, "high": F.col("value") + F.col("reach") + 0.0})
    reach.write.parquet(paths[1])
    reach = df.sparkSession.read.parquet(paths[1])
    asked = reach.select("feature", F.explode(F.array("low", "high")).alias("value"), F.lit(0).cast("bigint").alias("n"))
    places = counts.select("feature", "value", "n").unionByName(asked).groupBy("feature", "value").agg(F.sum("n").alias("n"))
    below = running_counts(places).select("feature", F.col("value").alias("_at"), "before", (F.col("before") + F.col("n")).alias("upto"))
    low = below.select(F.col("feature").alias("_f"), F.col("_at"), F.col("before").alias("first"))
    high = below.select(F.col("feature").alias("_f"), F.col("_at"), "upto")
    both = reach.join(low, (F.col("feature") == F.col("_f")) & (F.col("low") == F.col("_at"))).drop("_f", "_at")
    both = both.join(high, (F.col("feature") == F.col("_f")) & (F.col("high") == F.col("_at"))).drop("_f", "_at")
    within = (F.col("upto") - F.col("first")).cast("double")
    term = F.col("n") * (digamma(F.col("k").cast("double")) - digamma(F.col("in_class").cast("double")) - digamma(within))
    found = both.groupBy("feature").agg(F.sum("n").cast("double").alias("n"), F.sum(term).alias("s"))
    found = found.select("feature", F.greatest(F.lit(0.0), digamma(F.col("n")) + F.col("s") / F.col("n")).alias("mutual_information"))
    rows = found.collect()  # one row per column name
    for path in paths:
        remove(df.sparkSession, path)
    return df.sparkSession.createDataFrame(rows, found.schema).orderBy(F.desc("mutual_information"), "feature")


def fit_bins(df: DataFrame, columns: list[str], bins: int) -> dict[str, list[float]]:
    """Inner quantile edges of each column without duplicates: at most bins - 1 numbers per column."""
    inner = [i / bins for i in range(1, bins)]
    rows = quantiles(df, columns, inner).collect()
    return {r["feature"]: sorted({r[f"q{i}"] for i in range(len(inner))}) for r in rows}


def mutual_information(df: DataFrame, columns: list[str], target: str = ACTION, bins: int = 20,
                       target_bins: int | None = None) -> DataFrame:
    """Information (nats) between each quantile-binned column and a class, or a binned number with `target_bins`.

    One pass finds the edges, one counts bins against classes; only counts are shuffled.
    """
    edges = fit_bins(df, columns, bins)
    if target_bins:
        inner = fit_bins(df, [target], target_bins).get(target, [])
        marked = df.withColumn("_target", finite(target)).withColumn("_class", edges_below(F.col("_target"), inner).cast("string"))
    else:
        marked = df.withColumn("_class", F.col(target).cast("string"))
    numbers = marked.select("_class", *[finite(c).alias(c) for c in columns])
    binned = numbers.select("_class", *[edges_below(F.col(c), edges.get(c, [])).alias(c) for c in columns])
    binned = (
        binned.where(F.col("_class").isNotNull()).unpivot(["_class"], columns, "feature", "bin")
        .where(F.col("bin").isNotNull()).groupBy("feature", "bin", "_class").agg(F.count("*").alias("n"))
    )
    feature = Window.partitionBy("feature")
    shares = binned.withColumns({
        "total": F.sum("n").over(feature),
        "in_bin": F.sum("n").over(Window.partitionBy("feature", "bin")),
        "in_class": F.sum("n").over(Window.partitionBy("feature", "_class"))})
    share = F.col("n") / F.col("total")
    term = share * F.ln(F.col("n") * F.col("total").cast("double") / (F.col("in_bin").cast("double") * F.col("in_class")))
    return shares.groupBy("feature").agg(F.sum(term).alias("mutual_information")) \
        .orderBy(F.desc("mutual_information"), "feature")


def eda_summary(importance: DataFrame, correlations: DataFrame, leakage: list[str] = LEAKAGE, top: int = 5) -> DataFrame:
    """Strongest and weakest columns, largest correlations and known leaks as (section, position, item, value).

    `importance` has one row per column name; the weak list never repeats a strong one.
    """
    ranked = importance.select(
        "feature", "importance",
        F.row_number().over(Window.orderBy(F.desc("importance"), "feature")).alias("position"),
        F.count("*").over(Window.partitionBy()).alias("n"))
    strong = ranked.where(F.col("position") <= top).select(
        F.lit("top_predictors").alias("section"), "position", F.col("feature").alias("item"), F.col("importance").alias("value"))
    weak = ranked.where(F.col("position") > F.greatest(F.lit(top), F.col("n") - top)).select(
        F.lit("weak_predictors").alias("section"), "position", F.col("feature").alias("item"), F.col("importance").alias("value"))
    best = top_correlations(correlations).select(
        F.lit("highest_correlations").alias("section"),
        F.row_number().over(Window.orderBy(F.desc("strength"), "feature_1", "feature_2")).alias("position"),
        F.concat("feature_1", F.lit(" <-> "), "feature_2").alias("item"), F.col("strength").alias("value"))
    known = importance.where(F.col("feature").isin(*leakage)).select(
        F.lit("possible_target_leakage").alias("section"), F.lit(1).alias("position"), F.col("feature").alias("item"),
        F.col("importance").alias("value"))
    return strong.unionByName(weak).unionByName(best).unionByName(known)
