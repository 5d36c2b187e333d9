"""Label codes, one-hot columns and standard scaling."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from frostline.functions.numeric import finite
from frostline.operators.contracts import drop_identifier, split_features_targets
from frostline.operators.small import join_checked, rows_if_small, with_totals
from frostline.schema import ACTION, CARGO, ID, RISK, SENSORS
from frostline.workspace import fresh_path

LABEL_LIMIT = 1_000
LITERAL_LABELS = 32  # searched one by one in each row


def fit_labels(df: DataFrame, column: str, limit: int = LABEL_LIMIT) -> list[str] | None:
    """Distinct values in alphabetical order, or None when there are more than `limit`."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    rows = rows_if_small(values, limit)
    return None if rows is None else sorted(r[0] for r in rows)


def _code_of(column: str, labels: list[str]) -> Column:
    """Position in the list, null for an unlisted value; a literal, so no join."""
    position = F.array_position(F.lit(labels), F.col(column))
    return F.when(position > 0, position - 1)


def code_table(df: DataFrame, column: str) -> DataFrame:
    """Alphabetical codes for any number of labels.

    The labels are cut into ranges and written with their range's number, which then can't change; a code is a label's
    place in its range after all labels of earlier ranges.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, "labels")
    ranged = df.select(column).where(F.col(column).isNotNull()).distinct().repartitionByRange(F.col(column))
    ranged.withColumn("_range", F.spark_partition_id()).write.parquet(path)
    labels = spark.read.parquet(path)
    sizes = labels.groupBy("_range").agg(F.count("*").alias("_n"))  # one row per range
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column))
    return labels.withColumn("_place", place).join(starts, "_range").select(column, (F.col("_start") + F.col("_place") - 1).alias("code"))


def label_encode(df: DataFrame, column: str, labels: list[str] | None = None,
                 output: str = "code", limit: int = LABEL_LIMIT) -> DataFrame:
    """Alphabetical code of a label; labels fitted elsewhere may be passed in."""
    labels = labels if labels is not None else fit_labels(df, column, limit)
    if labels is not None and len(labels) <= LITERAL_LABELS:
        return df.withColumn(output, _code_of(column, labels).cast("bigint"))
    if labels is not None:
        known = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(labels)], f"`{column}` string, `{output}` bigint")
        return join_checked(df, known, [column], "left")
    codes = code_table(df, column).withColumnRenamed("code", output)
    return join_checked(df, codes, [column], "left")


def label_decode(df: DataFrame, code: str, labels: list[str], output: str = "label") -> DataFrame:
    """Label of a code; null for an unknown code."""
    known = F.col(code).between(0, len(labels) - 1)
    return df.withColumn(output, F.when(known, F.get(F.lit(labels), F.col(code).cast("int"))))


def one_hot(df: DataFrame, column: str, categories: list[str]) -> DataFrame:
    """One 0/1 column per category; an unseen value gives all zeros."""
    return df.withColumns({
        f"{column}_{c}": F.when(F.col(column) == c, 1).otherwise(0) for c in categories
    })


def scaling_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population deviation of every column, one row."""
    return df.agg(*[
        agg for c in columns for agg in (
            F.avg(finite(c)).alias(f"{c}|mean"), F.stddev_pop(finite(c)).alias(f"{c}|std"))
    ])


def standard_scale(df: DataFrame, columns: list[str], stats: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std; a constant column is only centred. `stats` may come from another frame."""
    stats = scaling_stats(df, columns) if stats is None else stats
    scaled = {}
    for c in columns:
        std = F.col(f"`{c}|std`")
        scaled[c] = (F.col(c) - F.col(f"`{c}|mean`")) / F.when(std == 0, F.lit(1.0)).otherwise(std)
    return with_totals(df, stats).withColumns(scaled).drop(*stats.columns)


def preprocess(df: DataFrame, key: str = ID, features: list[str] = SENSORS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Encode cargo and action, scale the sensors, and split into features and the two targets.

    The key stays so that the three tables can be joined again; `drop_identifier` removes it.
    """
    encoded = label_encode(df, CARGO, output="_cargo")
    encoded = label_encode(encoded, ACTION, output="_action")
    encoded = (encoded.drop(CARGO, ACTION)
               .withColumnsRenamed({"_cargo": CARGO, "_action": ACTION}))
    x, y_risk, y_action = split_features_targets(encoded, key, (RISK, ACTION))
    return standard_scale(x, [CARGO, *features]), y_risk, y_action


def preprocessed_matrix(df: DataFrame) -> DataFrame:
    return drop_identifier(preprocess(df)[0])
