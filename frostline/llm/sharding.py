"""Weighted rendezvous hashing of record keys over shards, with gapless slots inside each shard.

Every shard draws a number for a key, an exponential variable whose rate is the shard's weight, and the smallest draw
wins. A draw depends on the key and the shard's name alone, so one more shard takes rows only into itself and one
shard less gives away only its own rows.

A null key is a key of its own, null texts count as empty, and repeated rows get slots of their own. An empty table
gives an empty table. A column of `docs` that is called like the result is replaced; all others stay.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from frostline.llm.text import written

#: Rows that share one sort; the number of buckets follows the number of rows.
BUCKET_ROWS = 500_000
#: Equal rows that one task writes out in one go.
COPIES = 100_000
_DRAWS = 1 << 52


def key_text(*keys: str) -> Column:
    """One string for the values of a key; null differs from every value."""
    return F.to_json(F.struct(*[F.col(k) for k in keys]), {"ignoreNullFields": "false"})


def _draw(key: Column, shard: int, weight: float) -> Column:
    digits = F.substring(F.md5(F.concat(key, F.lit(f"/{shard}"))), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(_DRAWS))
    return -F.log(uniform) / F.lit(float(weight))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard, from 0, that wins `key`; a weight of 0 wins nothing."""
    draws = [F.struct(_draw(key, i, w).alias("d"), F.lit(i).alias("shard")) for i, w in enumerate(weights) if w > 0]
    return F.array_min(F.array(*draws))["shard"]


def assign(docs: DataFrame, keys: Sequence[str], weights: Sequence[float], out: str = "shard") -> DataFrame:
    """`docs` with the shard of every row: a projection, without a shuffle."""
    return docs.withColumn(out, shard_of(key_text(*keys), weights))


def write_shards(docs: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder for each shard, from as many tasks as hold its rows."""
    docs.write.partitionBy(shard).parquet(path)


def number(rows: DataFrame, shard: str, order: Column, rows_hint: int, out: str = "slot") -> DataFrame:
    """Gapless numbers from 0 inside each shard, by the 32 hex digits of `order` and then by all columns.

    Rows are cut into buckets by their first digits, numbered there, and moved up by the sizes of earlier buckets.
    Equal rows are counted before they travel and written out again in portions, so a hot row needs no task of its own.
    """
    columns = rows.columns
    buckets = max(1, rows_hint // BUCKET_ROWS)
    place = F.conv(F.substring("_order", 1, 8), 16, 10).cast("bigint") * buckets
    counted = rows.withColumn("_order", order).groupBy("_order", *columns).agg(F.count("*").alias("_n"))
    counted = counted.withColumn("_bucket", F.shiftright(place, 32))
    sizes = counted.groupBy(shard, "_bucket").agg(F.sum("_n").alias("_size"))
    earlier = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(shard, "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_from"))
    inside = Window.partitionBy(shard, "_bucket").orderBy("_order", *columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(sizes, [shard, "_bucket"])
    first = F.col("_from") + F.col("_before")
    few = placed.where(F.col("_n") <= COPIES).withColumn(out, F.explode(F.sequence(first, first + F.col("_n") - 1)))
    portions = F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / COPIES)))
    many = placed.where(F.col("_n") > COPIES).withColumn("_portion", portions).repartition("_order", "_portion")
    start = first + F.col("_portion") * COPIES
    last = F.least(start + COPIES, first + F.col("_n")) - 1
    many = many.withColumn(out, F.explode(F.sequence(start, last)))
    return few.select(*columns, out).unionByName(many.select(*columns, out))


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.lit("key").alias("law"))
    rows = assign(assign(rows, ["doc_id"], [1.0] * 8), ["doc_id"], [1.0] * 9, "grown_shard")
    rows = written(rows, "shards")  # numbering reads them more than once, and they are small beside the texts
    return number(rows, "shard", F.md5(key_text("doc_id")), rows.count())


_SHARDS = """list_reduce([struct_pack(d := -ln((('0x' || md5(k || '/' || i)[1:13])::BIGINT + 0.5) / 4503599627370496.0), i := i)
    FOR i IN range({n})], lambda a, b: CASE WHEN b.d < a.d THEN b ELSE a END).i::INTEGER"""
_CRC = """xor(list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::BIGINT),
    lambda c, b: xor(entries[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"""
SQL = f"""
WITH bits AS (
    SELECT [list_reduce([i] || range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)
        FOR i IN range(256)] AS entries),
docs AS (SELECT doc_id, coalesce(text, '') AS t,
    '{{"doc_id":' || coalesce(doc_id::VARCHAR, 'null') || '}}' AS k FROM documents),
placed AS (
    SELECT doc_id, k, (strlen(t) + 1)::BIGINT AS size, {_CRC}::BIGINT AS text_crc32, 'key' AS law,
        {_SHARDS.format(n=8)} AS shard, {_SHARDS.format(n=9)} AS grown_shard
    FROM docs, bits)
SELECT doc_id, size, text_crc32, law, shard, grown_shard,
    row_number() OVER (PARTITION BY shard ORDER BY md5(k), doc_id, size, text_crc32) - 1 AS slot
FROM placed
"""
