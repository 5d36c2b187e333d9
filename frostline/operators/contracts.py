"""Checks, filters and projections on a reading table."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from frostline.functions.decisions import RANGES, violation
from frostline.functions.numeric import not_finite
from frostline.schema import ACTION, ID, RISK


def missing_columns(df: DataFrame, columns: list[str]) -> list[str]:
    return sorted(set(columns) - set(df.columns))


def column_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """For each wanted column whether the table has it, and its rows with a value; one scan."""
    absent = set(missing_columns(df, columns))
    kind = "column string, present boolean, filled bigint"
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(c not in absent).alias("present"),
                                 (F.lit(0) if c in absent else F.count(F.col(f"`{c}`"))).cast("bigint").alias("filled")) for c in columns])
    return df.agg(entries.alias("e")).select(F.inline("e")) if columns else df.sparkSession.createDataFrame([], kind)


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The frame itself, or an error naming the missing columns; starts no job."""
    missing = missing_columns(df, columns)
    if missing:
        raise ValueError(f"The table lacks the columns {missing}.")
    return df


def stack_columns(wide: DataFrame, names: list[str], suffixes: list[str], label: str,
                  keep: list[str] | None = None) -> DataFrame:
    """One row per name from a wide aggregate with columns `<name>|<suffix>`."""
    keep = keep or []
    entries = F.array(*[
        F.struct(F.lit(n).alias(label), *[F.col(f"`{n}|{s}`").alias(s) for s in suffixes]) for n in names
    ])
    return wide.select(*keep, F.inline(entries))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per column, one scan."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}|nulls") for c in columns])
    return stack_columns(wide, columns, ["nulls"], "column")


def require_not_null(df: DataFrame, column: str) -> DataFrame:
    """The frame itself, or an error when the column has a null (stops at the first one found)."""
    if df.select(column).where(F.col(column).isNull()).limit(1).collect():
        raise ValueError(f"Rows without a value in {column}.")
    return df


def drop_identifier(df: DataFrame, columns: tuple[str, ...] = (ID,)) -> DataFrame:
    return df.drop(*columns)


def split_features_targets(df: DataFrame, key: str = ID,
                           targets: tuple[str, str] = (RISK, ACTION)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Features, regression target and class target, each with the key."""
    regression, classes = targets
    return df.drop(*targets), df.select(key, regression), df.select(key, classes)


def validate_ranges(df: DataFrame, ranges: Mapping[str, tuple] = RANGES) -> DataFrame:
    """Add `violations`: names of the columns that are missing or out of range."""
    found = F.array(*[violation(name, lo, hi) for name, (lo, hi) in ranges.items()])
    return df.withColumn("violations", F.filter(found, lambda name: name.isNotNull()))


def valid_rows(df: DataFrame) -> DataFrame:
    return df.where(F.size("violations") == 0).drop("violations")


def quarantined_rows(df: DataFrame) -> DataFrame:
    return df.where(F.size("violations") > 0)


def filter_class(df: DataFrame, label: str, column: str = ACTION) -> DataFrame:
    return df.where(F.col(column) == label)


def check_finite(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing and infinite values per column, one scan."""
    aggregates = []
    for c in columns:
        value = F.col(c).cast("double")
        missing = value.isNull() | F.isnan(value)
        aggregates += [
            F.count_if(missing).alias(f"{c}|missing"),
            F.count_if(not_finite(c) & ~missing).alias(f"{c}|infinite"),
        ]
    return stack_columns(df.agg(*aggregates), columns, ["missing", "infinite"], "feature")


def require_finite(df: DataFrame, columns: list[str]) -> DataFrame:
    bad = check_finite(df, columns).where("missing > 0 OR infinite > 0").collect()
    if bad:
        raise ValueError(f"Columns with missing or infinite values: {sorted(r['feature'] for r in bad)}")
    return df


def apply_feature_selection(df: DataFrame, features: list[str], target: str = ACTION) -> DataFrame:
    return require_columns(df, [*features, target]).select(*features, target)


def head_tail(df: DataFrame, key: str = ID, n: int = 5) -> DataFrame:
    """First and last rows by key; each side is a top-k, not a full sort."""
    first = df.orderBy(F.asc(key)).limit(n).withColumn("position", F.lit("first"))
    last = df.orderBy(F.desc(key)).limit(n).withColumn("position", F.lit("last"))
    return first.unionByName(last)


def class_counts(df: DataFrame, classes: list[str], column: str = ACTION) -> dict[str, int]:
    """Rows of each listed class; one row comes back whatever the table holds."""
    row = df.agg(*[F.count_if(F.col(column) == c).alias(c) for c in classes]).first()
    return row.asDict()


def assert_class_counts(df: DataFrame, expected: dict[str, int], column: str = ACTION) -> DataFrame:
    """Expected against actual rows per class, classes on either side kept."""
    spark = df.sparkSession
    wanted = spark.createDataFrame(list(expected.items()), "class string, expected bigint")
    actual = df.groupBy(F.col(column).alias("class")).agg(F.count("*").alias("actual"))
    joined = actual.join(wanted, "class", "full_outer")
    return joined.select(
        "class",
        F.coalesce("expected", F.lit(0)).alias("expected"),
        F.coalesce("actual", F.lit(0)).alias("actual"),
        (F.coalesce("expected", F.lit(0)) == F.coalesce("actual", F.lit(0))).alias("matches"),
    )


def require_class_counts(df: DataFrame, expected: dict[str, int], column: str = ACTION) -> DataFrame:
    wrong = assert_class_counts(df, expected, column).where(~F.col("matches")).limit(20).collect()
    if wrong:
        raise ValueError(f"Unexpected class balance: {[r.asDict() for r in wrong]}")
    return df
