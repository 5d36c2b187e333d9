"""Benchmark decontamination: Wu-Manber search for benchmark passages, with words as the alphabet.

A benchmark item of n words gives every window of `window` consecutive words; a shorter item is one window. Windows
of equal length are searched together. A block is the pair of words that ends at the position looked at: the shift
table says how far the search may jump without missing a window, and where it says zero the bucket of that block
holds the windows to compare word by word.

Nulls and empty texts have no words and no hits. Rows of the benchmark without words ask for nothing; without an id
they count as hits but are not listed. Repeated rows are judged one by one. An empty benchmark finds nothing. A
column of `docs` that is called like the result is replaced; all others stay.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from frostline.llm.text import WORD_PATTERN, native_words, split_words, written

#: Words of benchmark windows that one pass holds in memory; a larger benchmark is searched in several passes.
BLOCK_WORDS = 4_000_000
#: Bytes of a document that are split into words at once.
_PIECE = 1 << 22
RESULT = "struct<n_words: bigint, spans: array<struct<start: bigint, end: bigint>>, items: array<string>>"
_ARROW = pa.struct([
    ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("items", pa.list_(pa.string()))])

Words = tuple[bytes, ...]


class Search:
    """Wu-Manber tables for windows of one length."""

    def __init__(self, windows: dict[Words, set[str]]):
        self.length = len(next(iter(windows)))
        self.block = min(2, self.length)
        self.jump = self.length - self.block + 1
        self.shift: dict[Words, int] = {}
        self.bucket: dict[Words, list[Words]] = {}
        self.items = windows
        for words in windows:
            for end in range(self.block, self.length + 1):
                block, left = words[end - self.block:end], self.length - end
                self.shift[block] = min(left, self.shift.get(block, self.jump))
            self.bucket.setdefault(words[-self.block:], []).append(words)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, Words]]:
        """Start and window of every occurrence."""
        at, n, block, jump, shift = self.length, len(words), self.block, self.jump, self.shift
        while at <= n:
            here = tuple(words[at - block:at])
            step = shift.get(here, jump)
            if step:
                at += step
                continue
            found = tuple(words[at - self.length:at])
            if any(found == window for window in self.bucket[here]):
                yield at - self.length, found
            at += 1


def searches(items: list[tuple[str | None, bytes]], window: int) -> list[Search]:
    """One search for each length of window that the items have."""
    by_length: dict[int, dict[Words, set[str]]] = {}
    for item, text in items:
        words = split_words(text)
        for at in range(max(len(words) - window, 0) + 1 if words else 0):
            part = tuple(words[at:at + window])
            by_length.setdefault(len(part), {}).setdefault(part, set()).update([item] if item is not None else [])
    return [Search(windows) for _, windows in sorted(by_length.items())]


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in parts that end between words."""
    at = 0
    while at < len(text):
        end = at + _PIECE
        while end < len(text) and split_words(text[end:end + 1]):
            end += 1
        yield text[at:end]
        at = end


def leaks(text: bytes, tables: list[Search]) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, merged spans of words inside occurrences, and items that occur."""
    spans: list[tuple[int, int]] = []
    items: set[str] = set()
    reach = max((t.length for t in tables), default=1) - 1
    words: list[bytes] = []
    done = 0
    for piece in _pieces(text):
        kept = words[max(len(words) - reach, 0):]
        done += len(words) - len(kept)
        words = kept + split_words(piece)
        for table in tables:
            skip = max(len(kept) - table.length + 1, 0)
            for start, found in table.find(words[skip:]):
                spans.append((done + skip + start, done + skip + start + table.length))
                items |= table.items[found]
    return done + len(words), merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlap; touching ones are joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find_leaks(docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", out: str = "leaks", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every row of `docs` with a struct `out`: n_words, spans (merged [start, end) in words) and items (sorted ids).

    The benchmark is collected in blocks of about `block_words` window words, one block and one pass at a time.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    words = F.size(native_words(F.col("text")))
    total = asked.select(F.sum(words.cast("bigint") * window)).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    docs = docs.drop(out)
    schema = StructType([*docs.schema.fields, StructField(out, StructType.fromDDL(f"x {RESULT}")[0].dataType)])
    for i in range(blocks):
        rows = asked.where(block == i).distinct().collect()
        tables = spark.sparkContext.broadcast(searches([(r.item, r.text.encode()) for r in rows], window))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                before = batch.column(out).to_pylist() if out in batch.schema.names else [None] * batch.num_rows
                found = []
                for value, old in zip(batch.column(text).cast(pa.large_binary()), before, strict=True):
                    n, spans, ids = leaks(value.as_py() or b"", tables.value)
                    if old:
                        spans = merged(spans + [(s["start"], s["end"]) for s in old["spans"]])
                        ids |= set(old["items"])
                    found.append({"n_words": n, "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(ids)})
                names = [x for x in batch.schema.names if x != out]
                yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(found, _ARROW)], [*names, out])

        docs = docs.mapInArrow(scan, schema)
        if i + 1 < blocks:
            docs = written(docs, "leaks")
    return docs


def hit_words(leaks: Column) -> Column:
    """Words inside any occurrence."""
    return F.aggregate(leaks["spans"], F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = hit_words(F.col("leaks"))
    return found.select(
        "doc_id", F.col("leaks.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("leaks.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("leaks.items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '{WORD_PATTERN}') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all({_LOWERED}, '{WORD_PATTERN}') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS words
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
places AS (
    SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS words
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT r, i, p.n, item_id FROM places p JOIN windows w ON p.n = w.n AND p.words = w.words),
counts AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS x FROM hits) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN counts USING (r) LEFT JOIN named USING (r)
"""


def decontamination_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("leaks.spans") == 0).drop("leaks")
