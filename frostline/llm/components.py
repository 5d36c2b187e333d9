"""Connected components of a table of links, by alternating stars, in joins and aggregations."""

from pyspark.sql import DataFrame, functions as F

from frostline.llm.text import Scratch


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    around = _both_ways(links)
    least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, left: str, right: str, scratch: Scratch | None = None) -> DataFrame:
    """(node, root) for every linked node but the roots; a root is the smallest node of its component.

    Nodes are of any type with an order. Rounds go on until the links stay as they are; each is written to the shared
    folder (among the caller's tables, if there are any), so that a lost executor costs one round.
    """
    scratch = scratch or Scratch(links.sparkSession, "components")
    links = links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
    links, before = scratch.written(links, "links"), None
    while True:
        links = scratch.written(_small_star(_large_star(links)), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
