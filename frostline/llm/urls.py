"""Judging URLs by listed rules: a blocked Bloom filter first, an exact join for what passes.

A rule has a host, a path prefix and a verdict. It fits its host and all subdomains when the path starts with the
prefix; the longest rule wins, at equal length the one with the longer host. Beside rules, single canonical URLs can
be listed. All of them are keys of one filter: 512-bit blocks, six bits of one block for a key. A URL asks for its
host suffixes with every prefix length that rules have, and for its canonical form.

Null URLs and those without `://` have an empty host and path; no rule fits them. Repeated rows are judged alike. Empty
tables of rules or URLs give the default verdict for all, or no row. Columns called like a result are replaced.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from frostline.llm.text import LOWER, UPPER

#: Bits for each key, and the most blocks: 2**17 blocks of 64 bytes are 8 MB. A longer list makes a fuller filter.
KEY_BITS = 16
MOST_BLOCKS = 1 << 17
_BITS, _WORDS = 6, 8
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Without scheme, query and fragment, a leading www. and trailing slashes."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", ""))


def _bit(key: Column, j: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(1), key), 9 * j).bitwiseAND(F.lit(511))


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> Column:
    """A scalar subquery: the filter as an array of 8 * blocks numbers, made by one aggregation over blocks."""
    def word(i: int) -> Column:
        parts = [F.when(F.shiftright(bit, 6) == i, F.call_function("shiftleft", F.expr("1L"), bit.bitwiseAND(F.lit(63)).cast("int")))
                 .otherwise(F.expr("0L")) for bit in (_bit(F.col(key), j) for j in range(_BITS))]
        return F.bit_or(reduce(Column.bitwiseOR, parts)).alias(f"w{i}")

    filled = keys.groupBy(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("id")).agg(*[word(i) for i in range(_WORDS)])
    every = keys.sparkSession.range(blocks).join(filled, "id", "left")
    words = F.array(*[F.coalesce(f"w{i}", F.expr("0L")) for i in range(_WORDS)])
    rows = F.sort_array(F.collect_list(F.struct("id", words.alias("words"))))
    return every.agg(F.flatten(F.transform(rows, lambda r: r["words"])).alias("filter")).scalar()


def may_hold(filter: Column, key: Column, blocks: int) -> Column:
    """False when the key is surely not listed."""
    block = F.pmod(F.xxhash64(key), F.lit(blocks)) * _WORDS
    passed = F.lit(True)
    for j in range(_BITS):
        bit = _bit(key, j)
        found = F.get(filter, (block + F.shiftright(bit, 6)).cast("int"))
        passed &= F.call_function("shiftright", found, bit.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
    return passed


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame, url: str = "url", default: str = "allow",
          listed_verdict: str = "block") -> DataFrame:
    """`pages` with host, path, rule (`host` + `path` of the rule, else null) and verdict.

    rules: host, path, verdict. listed: a column `canonical` of URLs as `canonical()` writes them.
    """
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("h"), F.col("path").alias("p"), F.col("verdict").alias("v"))
    rules = rules.where("h IS NOT NULL AND p IS NOT NULL AND h <> ''")
    rules = rules.groupBy(F.concat(F.lit("r"), "h", "p").alias("key")).agg(
        F.first(F.concat("h", "p")).alias("rule"), F.min("v").alias("v"), F.first(F.length("h")).alias("host_size"),
        F.first(F.length("p")).alias("path_size"))
    exact = listed.select(F.concat(F.lit("u"), "canonical").alias("key")).where("key IS NOT NULL").distinct()
    exact = exact.select("key", F.lit(None).cast("string").alias("rule"), F.lit(listed_verdict).alias("v"),
                         F.lit(0).alias("host_size"), F.lit(0).alias("path_size"))
    keys = rules.unionByName(exact)
    blocks = min(MOST_BLOCKS, max(1, -(-keys.count() * KEY_BITS // 512)))
    shape = rules.agg(F.collect_set("path_size").alias("sizes"),
                      F.max(F.size(F.split(F.substring_index("rule", "/", 1), r"\."))).alias("labels")).first()

    split = pages.select(F.col(url).alias("_url")).where("_url IS NOT NULL").distinct()
    split = split.withColumn("host", host_of(F.col("_url"))).withColumn("path", path_of(F.col("_url"))).where("host <> ''")
    labels = F.split("host", r"\.")
    suffixes = [F.when(F.size(labels) >= n, F.substring_index("host", ".", -n)) for n in range(1, (shape.labels or 0) + 1)]
    asked = [F.when(F.length("path") >= size, F.concat(F.lit("r"), s, F.substring(F.col("path"), 1, size)))
             for s in suffixes for size in sorted(shape.sizes)]
    asked.append(F.concat(F.lit("u"), canonical(F.col("host"), F.col("path"))))
    asked = split.select("_url", F.explode(F.array_distinct(F.array(*asked))).alias("key"))
    passed = asked.where(F.col("key").isNotNull() & may_hold(bloom_filter(keys, "key", blocks), F.col("key"), blocks))
    hits = passed.join(keys, "key").groupBy("_url").agg(
        F.max(F.struct(F.expr("host_size + path_size").alias("size"), "host_size", "rule", "v")).alias("_hit"))
    judged = pages.withColumn("_url", F.col(url)).join(hits, "_url", "left")
    return (judged.withColumn("host", host_of(F.col("_url"))).withColumn("path", path_of(F.col("_url")))
            .withColumn("rule", F.col("_hit.rule")).withColumn("verdict", F.coalesce("_hit.v", F.lit(default)))
            .drop("_url", "_hit"))


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def shared_urls(pages: DataFrame) -> DataFrame:
    """Canonical URLs that more than one page claims: their content can't be told from the address."""
    host = host_of(F.col("url"))
    address = pages.where(host != "").select("page_id", canonical(host, path_of(F.col("url"))).alias("canonical"))
    return address.groupBy("canonical").agg(F.min("page_id").alias("a"), F.max("page_id").alias("b")).where("a < b").select("canonical")


def op7_urls(spark, sf_dir: str) -> DataFrame:
    """Rules win; without one, URLs whose canonical form several pages claim are blocked."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(pages, rules, shared_urls(pages)).select("page_id", "host", "path", "rule", "verdict")


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
SQL = rf"""
WITH rules(h, p, v) AS (VALUES {_RULE_ROWS}),
split AS (SELECT row_number() OVER () AS r, page_id,
    translate(coalesce(regexp_extract(url, '{_URL}', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '{_URL}', 2), '') AS path FROM pages),
named AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') END AS c FROM split),
shared AS (SELECT c FROM named WHERE c IS NOT NULL GROUP BY c HAVING count(DISTINCT page_id) > 1),
best AS (SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM named, rules
    WHERE (host = h OR host LIKE '%.' || h) AND starts_with(path, p) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN c IN (SELECT c FROM shared) THEN 'block' END, 'allow') AS verdict
FROM named LEFT JOIN best USING (r)
"""
