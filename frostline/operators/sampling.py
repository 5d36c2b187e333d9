"""Exact splits and samples in hash order, without sorting the table.

Rows are ordered by md5 of key and seed, and rows of one key by a hash of their columns. A
split point is found from a histogram of hash prefixes: only the one prefix that holds the
point is ranked, then every row is labelled by comparing with the point. That is one
aggregate, one filtered scan and one projection; the whole table is never shuffled, however
skewed the classes or keys are. A missing key is a key. Rows that are equal in all columns
are told apart by number where a point falls among them.
"""

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from frostline.functions.draws import digest, uniform
from frostline.functions.numeric import edges_below
from frostline.operators.quantiles import quantiles
from frostline.operators.small import rows_if_small, with_totals
from frostline.schema import ACTION, ID

PREFIX_DIGITS = 3
RANKED_ROWS = 2_000_000
STRATA_LIMIT = 1_000
_ORDER = "order"
_DIGITS = 48  # of md5 and of the row's hash


def _stratum(by: str | None) -> Column:
    """Stratum name; a missing value is a stratum of its own."""
    return F.coalesce(F.col(by).cast("string"), F.lit("\u0000null")) if by else F.lit("all")


def _place(key: str, seed: int, columns: list[str]) -> Column:
    """Hex digits that order rows: md5 of the key, then 64 bits of the columns."""
    values = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.concat(digest(key, seed, _ORDER), F.lpad(F.hex(F.xxhash64(*values)), 16, "0"))


def _hashed(df: DataFrame, key: str, seed: int, by: str | None, columns: list[str]) -> DataFrame:
    return df.select(_stratum(by).alias("stratum"), _place(key, seed, columns).alias("h"))


def _running(counts: DataFrame, group: list[str]) -> DataFrame:
    """Running and total rows over the hash prefixes of each group."""
    whole = Window.partitionBy(*group)
    so_far = whole.orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumns({"upto": F.sum("n").over(so_far), "total": F.sum("n").over(whole)})


def _prefix_counts(hashed: DataFrame, digits: int) -> DataFrame:
    """Rows per stratum and hash prefix: at most 16**digits per stratum, combined before the shuffle."""
    counts = hashed.groupBy("stratum", F.substring("h", 1, digits).alias("prefix")).agg(F.count("*").alias("n"))
    return _running(counts, ["stratum"])


def _cut_points(df: DataFrame, key: str, seed: int, by: str | None, ranks, columns: list[str]) -> list | None:
    """For each stratum and wanted rank, the hash of the row at that rank; how many rows have it, and how many to take.

    `ranks(total)` lists the wanted 1-based ranks as columns; None when there are too many strata.
    A prefix that holds a wanted rank but too many rows is divided again by its next digits.
    """
    spark = df.sparkSession
    hashed = _hashed(df, key, seed, by, columns)
    prefixes = _prefix_counts(hashed, PREFIX_DIGITS)
    before = F.col("upto") - F.col("n")
    wanted = ranks(F.col("total"))
    holds = [(rank > before) & (rank <= F.col("upto")) for rank in wanted]
    held_frame = (
        prefixes.withColumn("cut", F.array(*[
            F.when(hold, F.struct(F.lit(no).alias("no"), (rank - before).alias("rank")))
            for no, (rank, hold) in enumerate(zip(wanted, holds))]))
        .select("stratum", "prefix", "n", F.explode("cut").alias("cut")).where("cut IS NOT NULL")
        .select("stratum", "prefix", "n", "cut.no", "cut.rank")
    )
    held = rows_if_small(held_frame, STRATA_LIMIT)
    if held is None:
        return None
    digits = PREFIX_DIGITS
    while True:
        if not held:
            return []
        cuts = F.broadcast(spark.createDataFrame(held, "stratum string, prefix string, n bigint, no int, rank bigint"))
        near = (
            hashed.withColumn("prefix", F.substring("h", 1, digits))
            .join(cuts.drop("n"), ["stratum", "prefix"])
        )
        if max(r["n"] for r in held) <= RANKED_ROWS or digits >= _DIGITS:
            # one row per hash before it is ranked, so equal rows are one
            alike = near.groupBy("stratum", "no", "rank", "h").agg(F.count("*").alias("ties"))
            before = Window.partitionBy("stratum", "no").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
            taken = alike.withColumn("take", F.col("rank") - F.coalesce(F.sum("ties").over(before), F.lit(0)))
            at_rank = taken.where("take > 0 AND take <= ties")
            return at_rank.select("stratum", "no", "h", "ties", "take").collect()  # one row per cut
        digits += PREFIX_DIGITS
        finer = (
            near.groupBy("stratum", "no", "rank", F.substring("h", 1, digits).alias("prefix"))
            .agg(F.count("*").alias("n"))
        )
        held = (
            _running(finer, ["stratum", "no"]).where((F.col("rank") > before) & (F.col("rank") <= F.col("upto")))
            .select("stratum", "prefix", "n", "no", (F.col("rank") - before).alias("rank")).collect()
        )


def _numbered_ties(tagged: DataFrame, points: list[str]) -> DataFrame:
    """Add `_n`: the number of a row among its equals where `_h` is one of `points`, else 1."""
    if not points:
        return tagged.withColumn("_n", F.lit(1))
    equals = Window.partitionBy("_s", "_h").orderBy("_h")
    at = F.col("_h").isin(points)
    return tagged.where(at).withColumn("_n", F.row_number().over(equals)).unionByName(tagged.where(~at).withColumn("_n", F.lit(1)))


def _up_to(h: Column, take: Column) -> Column:
    """At or before a point; of rows equal to it the first `take`."""
    return (F.col("_h") < h) | ((F.col("_h") == h) & (F.col("_n") <= take))


def prefix_digits(rows: int) -> int:
    """Hex digits after which a prefix has about `RANKED_ROWS` / 16 rows or fewer, two at least."""
    return max(2, math.ceil(math.log(max(rows, 1) * 16 / RANKED_ROWS, 16)))


def number_rows(df: DataFrame, key: str = ID, seed: int = 42, by: str | None = None,
                digits: int | None = None, output: str = "row_no") -> DataFrame:
    """Exact 0-based position in hash order (per `by`), ranked inside small hash prefixes.

    The length of the prefixes follows the number of rows. The rank window and the join with the prefix offsets use the same partitioning, so
    the rows are shuffled once and no task holds more than one prefix at a time.
    """
    digits = digits or prefix_digits(df.count())
    tagged = df.withColumns({"_s": _stratum(by), "_h": _place(key, seed, df.columns)}) \
               .withColumn("_p", F.substring("_h", 1, digits))
    in_prefix = Window.partitionBy("_s", "_p").orderBy("_h")
    placed = tagged.withColumn("_place", F.row_number().over(in_prefix))
    offsets = _prefix_counts(_hashed(df, key, seed, by, df.columns), digits).select(
        F.col("stratum").alias("_s"), F.col("prefix").alias("_p"),
        (F.col("upto") - F.col("n")).alias("_before"), F.col("total").alias("_total"))
    return (
        placed.join(offsets, ["_s", "_p"])
        .withColumn(output, F.col("_before") + F.col("_place") - 1)
        .drop("_s", "_p", "_h", "_place", "_before")
        .withColumnRenamed("_total", f"{output}_of")
    )


def _cumulative(fractions: Mapping[str, float]) -> list[float]:
    total, out = 0.0, []
    for share in list(fractions.values())[:-1]:
        total = round(total + share, 12)
        out.append(total)
    return out


def _quota(total: Column, share: float) -> Column:
    """Rows up to a cumulative share, rounded half-even."""
    return F.bround(total.cast("double") * F.lit(share), 0).cast("bigint")


@dataclass(frozen=True)
class SplitRule:
    """A fitted split: names in order, and per stratum the last hash of each split but the last and the rows to take of it.

    `columns` went into the hash; `partial` lists hashes of equal rows that a limit divides. `limits` is None when there are more strata than `STRATA_LIMIT`; rows are then ranked instead.
    """

    by: str
    names: list[str]
    cumulative: list[float]
    seed: int
    key: str
    columns: list[str]
    limits: list[list] | None
    partial: list[str]


def fit_split(df: DataFrame, by: str, fractions: Mapping[str, float], seed: int = 42, key: str = ID,
              columns: list[str] | None = None) -> SplitRule:
    """`columns` tell rows of one key apart; all of them unless given."""
    names, cumulative, columns = list(fractions), _cumulative(fractions), columns or df.columns
    points = _cut_points(df, key, seed, by, lambda total: [_quota(total, share) for share in cumulative], columns)
    limits = None
    if points is not None:
        by_stratum: dict[str, dict[int, tuple]] = {}
        for p in points:
            by_stratum.setdefault(p["stratum"], {})[p["no"]] = (p["h"], p["take"])
        limits = [[s, *[part for no in range(len(cumulative)) for part in found.get(no, (None, None))]]
                  for s, found in by_stratum.items()]
    partial = sorted({p["h"] for p in points or [] if p["take"] < p["ties"]})
    return SplitRule(by, names, cumulative, seed, key, columns, limits, partial)


def apply_split(df: DataFrame, rule: SplitRule, output: str = "split") -> DataFrame:
    """Label every row by comparing its hash with the limits of its stratum: a projection, no shuffle."""
    if rule.limits is None:
        ranked = number_rows(df, rule.key, rule.seed, rule.by, output="_no")
        passed = edges_below_columns(F.col("_no") + 1, [_quota(F.col("_no_of"), share) for share in rule.cumulative])
        return ranked.withColumn(output, F.get(F.lit(rule.names), passed)).drop("_no", "_no_of")
    cuts = range(len(rule.cumulative))
    columns = ", ".join(["_s string", *[f"_h{no} string, _k{no} bigint" for no in cuts]])
    limits = df.sparkSession.createDataFrame(rule.limits, columns)  # at most STRATA_LIMIT rows
    label = F
    for no in cuts:  # a quota of 0 has no point: the comparison is null and the next split is tried
        label = label.when(_up_to(F.col(f"_h{no}"), F.col(f"_k{no}")), F.lit(rule.names[no]))
    label = F.lit(rule.names[-1]) if label is F else label.otherwise(F.lit(rule.names[-1]))
    tagged = df.withColumns({"_s": _stratum(rule.by), "_h": _place(rule.key, rule.seed, rule.columns)})
    joined = _numbered_ties(tagged, rule.partial).join(F.broadcast(limits), "_s", "left").withColumn(output, label)
    return joined.drop("_s", "_h", "_n", *[f"_{part}{no}" for part in "hk" for no in cuts])


def edges_below_columns(value: Column, edges: list[Column]) -> Column:
    """Number of edge columns smaller than the value."""
    return sum((F.when(value > e, 1).otherwise(0) for e in edges), F.lit(0))


def stratified_split(df: DataFrame, by: str = ACTION, fractions: Mapping[str, float] | None = None,
                     seed: int = 42, key: str = ID) -> DataFrame:
    """Add `split`: every stratum is divided in the given shares, exact to the row.

    `by` is the stratum column, `fractions` an ordered mapping of split name to share.
    """
    return apply_split(df, fit_split(df, by, fractions or {"train": 0.8, "test": 0.2}, seed, key))


def sample_n(df: DataFrame, n: int, seed: int = 42, key: str = ID) -> DataFrame:
    """Exactly n rows without replacement; an error when there are fewer."""
    if n <= 0:
        return df.limit(0)
    points = _cut_points(df, key, seed, None, lambda total: [F.lit(n).cast("bigint")], df.columns)
    if not points:
        raise ValueError(f"The table has fewer rows than the {n} to draw.")
    point = points[0]
    tagged = df.withColumns({"_s": F.lit("all"), "_h": _place(key, seed, df.columns)})
    numbered = _numbered_ties(tagged, [point["h"]] if point["take"] < point["ties"] else [])
    return numbered.where(_up_to(F.lit(point["h"]), F.lit(point["take"]))).drop("_s", "_h", "_n")


def draw_indices(spark: SparkSession, n: int, total: DataFrame, seed: int, stream: str) -> DataFrame:
    """n draws of a position below `total.n`, one row per draw."""
    draw = uniform(digest("draw_id", seed, stream), 0)
    draws = with_totals(spark.range(n).withColumnRenamed("id", "draw_id"), total)
    return draws.withColumn("pick", F.floor(draw * F.col("n"))).drop("n")


def sample_with_replacement(seeds: DataFrame, n: int, seed: int = 42, key: str = ID,
                            stream: str = "pick", digits: int | None = None) -> DataFrame:
    """n draws of seed rows, numbered by `draw_id`.

    Picks are uniform, so the join key is spread evenly; Spark chooses the join by size.
    """
    numbered = number_rows(seeds, key, seed, None, digits, "pick").drop("pick_of")
    picks = draw_indices(seeds.sparkSession, n, seeds.agg(F.count("*").alias("n")), seed, stream)
    return picks.join(numbered, "pick").drop("pick")


def shuffle_rows(df: DataFrame, seed: int = 42, key: str = ID) -> DataFrame:
    """Random order, as a range-partitioned sort; `shuffle_key` tells the order."""
    return df.withColumn("shuffle_key", digest(key, seed, "shuffle")).orderBy("shuffle_key", key)


def fit_strata(df: DataFrame, column: str, q: int = 10) -> list[float]:
    """Quantile edges with duplicates dropped: at most q + 1 numbers."""
    probs = [i / q for i in range(q + 1)]
    row = quantiles(df, [column], probs).first()
    if row is None:
        raise ValueError("The target has too few distinct values for strata of two rows or more.")
    return sorted({row[f"q{i}"] for i in range(q + 1)})


def stratum_of(column: str, edges: list[float]) -> Column:
    """0-based right-closed bin, lowest edge included; null outside."""
    value = F.col(column)
    return F.when(value.between(edges[0], edges[-1]), edges_below(value, edges[1:-1]))


def _require_strata(marked: DataFrame, edges: list[float], output: str) -> None:
    sizes = marked.groupBy(output).agg(F.count("*").alias("n")).collect()  # at most q + 1 rows
    if len(edges) < 2 or min(r["n"] for r in sizes) < 2:
        raise ValueError("The target has too few distinct values for strata of two rows or more.")


def quantile_strata(df: DataFrame, column: str, q: int = 10, output: str = "stratum") -> DataFrame:
    """Add the quantile stratum of a target; an error when a stratum has fewer than two rows."""
    edges = fit_strata(df, column, q)
    marked = df.withColumn(output, stratum_of(column, edges))
    _require_strata(marked, edges, output)
    return marked


def regression_split(df: DataFrame, target: str, test: float = 0.15, validation: float = 0.15,
                     q: int = 10, seed: int = 42, key: str = ID) -> DataFrame:
    """Train/validation/test on target quantiles, strata recomputed after the test rows are taken.

    Fitting works on the key and the target only; the result is one projection over the table.
    """
    share = validation / (1.0 - test)
    slim = df.select(key, target).persist()
    try:
        outer_edges = fit_strata(slim, target, q)
        marked = slim.withColumn("_stratum", stratum_of(target, outer_edges))
        _require_strata(marked, outer_edges, "_stratum")
        outer = fit_split(marked, "_stratum", {"rest": 1.0 - test, "test": test}, seed, key, [key, target])
        rest = apply_split(marked, outer, "_outer").where(F.col("_outer") == "rest").select(key, target).persist()
        try:
            inner_edges = fit_strata(rest, target, q)
            again = rest.withColumn("_stratum", stratum_of(target, inner_edges))
            _require_strata(again, inner_edges, "_stratum")
            inner = fit_split(again, "_stratum", {"train": 1.0 - share, "validation": share}, seed + 1, key, [key, target])
        finally:
            rest.unpersist()
    finally:
        slim.unpersist()
    tested = apply_split(df.withColumn("_stratum", stratum_of(target, outer_edges)), outer, "_outer")
    both = apply_split(tested.withColumn("_stratum", stratum_of(target, inner_edges)), inner, "split")
    decided = F.when(F.col("_outer") == "test", F.lit("test")).otherwise(F.col("split"))
    return both.withColumn("split", decided).drop("_stratum", "_outer")


def split_report(df: DataFrame, column: str = ACTION, split: str = "split") -> DataFrame:
    """Rows and share of each class in each split and in the whole table."""
    counts = df.groupBy(F.col(split).alias("split"), F.col(column).alias("class")).agg(F.count("*").alias("count"))
    whole = counts.groupBy("class").agg(F.sum("count").alias("count")).select(F.lit("original").alias("split"), "class", "count")
    both = counts.unionByName(whole)
    in_split = F.sum("count").over(Window.partitionBy("split"))
    return both.select(
        "split", "class", "count", in_split.alias("total"),
        F.bround(F.col("count") / in_split * 100.0, 2).alias("percentage"))
