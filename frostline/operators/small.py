"""Joining a table that is usually small, without trusting that it is."""

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SMALL_ROWS = 100_000


def rows_if_small(df: DataFrame, limit: int = SMALL_ROWS) -> list | None:
    """The rows when there are at most `limit`, else None; never fetches more than that."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def table_if_small(df: DataFrame, limit: int = SMALL_ROWS) -> pa.Table | None:
    """The same as an Arrow table, from which `createDataFrame` makes a relation of known size."""
    table = df.limit(limit + 1).toArrow()
    return table if table.num_rows <= limit else None


def join_checked(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                 limit: int = SMALL_ROWS) -> DataFrame:
    """Broadcast `small` only after counting it; otherwise a shuffled join that AQE can split."""
    rows = rows_if_small(small, limit)
    if rows is not None:
        small = F.broadcast(big.sparkSession.createDataFrame(rows, small.schema))
    return big.join(small, on, how)


def with_totals(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate as a scalar subquery: no join, and more rows are an error."""
    packed = one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias("_totals")).scalar()
    return df.withColumn("_totals", packed).select("*", "_totals.*").drop("_totals")
