"""Ranked lexical search: the best documents for each query item, by groups of documents that match the same terms.

One scan turns documents into counts of those terms that the items ask for. A task then takes documents in blocks. For
each item the bitmaps of its terms over the block are laid over each other: a document's bits say which of the item's
terms it has, its mask. Documents of one mask form a group, whose greatest possible score is the sum over the mask's
terms of their weight times the greatest part that the term has in any document of the block. Masks are evaluated by
that bound, highest first, until the item has its `top` documents and the next bound lies below the last of them; what
remains can't enter. Scores found in earlier blocks of the task count too. The few rows that tasks keep meet by item.

Terms are the longest runs of letters, digits and characters beyond ASCII, with A-Z lower-cased (as in `text`). They are
found by 64-bit hashes and then compared byte by byte. A null or empty text has no terms and counts for nothing. Equal
scores rank by ascending id, null last. Repeated documents are ranked one by one, repeated items each have their rows.
Items without terms, and items that no document scores above 0 for, have none. Empty tables give no row. Only the named
columns are read; ids may be of any type with an order.

Items are searched in blocks of about `block_terms` terms, one pass over the documents for each; the block's terms and
weights are all that is broadcast. Weights use the counts of all documents.
"""

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from frostline.llm.text import WORD_PATTERN, flat_bytes, hashed_words, native_words, small_slices, split_words, word_spans, written, _FOLD_ZERO

TOP, BLOCK_TERMS = 10, 1_000_000
#: Postings that a block of documents has, about; documents that are scored between two looks at the bound, at least.
BLOCK_POSTINGS, AT_ONCE = 2_000_000, 32
#: Fixed numbers of the score: a whole unit of a term's part, its scale, and what a document's length adds to it.
UNIT, TF, LENGTH, SHARE = 1_000_000_000, 1000, 8, 75


def weight(n: int, df: int) -> int:
    """Of a term that `df` of `n` documents have."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Terms:
    """Terms that are looked up in texts, numbered from 0."""

    def __init__(self, terms: list[bytes]):
        self.n = len(terms)
        self.data = np.frombuffer(b"".join(terms), np.uint8)
        self.size = np.array([len(t) for t in terms], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        hashes, _ = hashed_words(pa.array(terms, pa.binary()))
        order = np.argsort(hashes, kind="stable")
        again = np.zeros(len(terms), np.int64)  # terms of one hash go to tables of their own
        for i in range(1, len(terms)):
            if hashes[order[i]] == hashes[order[i - 1]]:
                again[i] = again[i - 1] + 1
        self.tables = [(hashes[order[again == a]], order[again == a]) for a in range(int(again.max(initial=-1)) + 1)]

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text; and for every text and term that it has: row, term and how often, by row and term."""
        data, bounds = flat_bytes(texts)
        hashes, starts, stops, rows = word_spans(data, bounds)
        found = [self._looked_up(data, hashes, starts, stops, *table) for table in self.tables]
        at = np.concatenate([a for a, _ in found] or [np.zeros(0, np.int64)])
        term = np.concatenate([t for _, t in found] or [np.zeros(0, np.int64)])
        row = np.searchsorted(rows, at, "right") - 1
        pair, tf = np.unique(row * max(self.n, 1) + term, return_counts=True)
        return np.diff(rows), pair // max(self.n, 1), pair % max(self.n, 1), tf

    def _looked_up(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray, names: np.ndarray,
                   numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words that are terms, by hash, length and bytes."""
        spot = np.minimum(np.searchsorted(names, hashes), len(names) - 1)
        at = np.flatnonzero(names[spot] == hashes)
        term = numbers[spot[at]]
        same = stops[at] - starts[at] == self.size[term]
        at, term = at[same], term[same]
        if not len(at):
            return at, term
        size = self.size[term]
        before = np.cumsum(size) - size
        inside = np.arange(before[-1] + size[-1]) - np.repeat(before, size)
        equal = _FOLD_ZERO[data[inside + np.repeat(starts[at], size)]] == self.data[inside + np.repeat(self.begin[term], size)]
        same = np.logical_and.reduceat(equal, before)
        return at[same], term[same]


def postings(docs: DataFrame, terms: Terms, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, tf) for every document with words: how many, and which of `terms` it has how often."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text"):
                n, row, term, tf = shared.value.counts(batch.column("text"))
                kept = np.flatnonzero(n)
                at = pa.array(np.append(np.searchsorted(row, kept), len(row)), pa.int32())
                lists = (pa.ListArray.from_arrays(at, pa.array(c, pa.int32())) for c in (term, tf))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(kept)), pa.array(n[kept], pa.int64()), *lists], ["doc_id", "n", "terms", "tf"])

    held = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL")
    kind = held.schema["doc_id"].dataType.simpleString()
    return held.mapInArrow(made, f"doc_id {kind}, n bigint, terms array<int>, tf array<int>")


class Block:
    """Postings of some documents, by document and by term."""

    def __init__(self, n: np.ndarray, bounds: np.ndarray, terms: np.ndarray, tf: np.ndarray, count: int, documents: int, length: int):
        self.rows, self.bounds, self.terms = len(n), bounds, terms
        sizes, which = np.unique(n, return_inverse=True)
        m = np.array([100 - SHARE + SHARE * int(x) * documents // length for x in sizes], np.int64)[which]
        doc = np.repeat(np.arange(self.rows), np.diff(bounds))
        self.part = UNIT * tf // (TF * tf + LENGTH * m[doc])
        order = np.argsort(terms, kind="stable")
        self.docs = doc[order]
        self.first = np.searchsorted(terms[order], np.arange(count + 1))
        self.most = np.zeros(count, np.int64)  # greatest part of each term in the block
        held = np.flatnonzero(np.diff(self.first))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.part[order], self.first[held])

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents with some of the terms, and their masks: one row of bits, in 64-bit numbers, for each."""
        bits = np.zeros((self.rows, -(-len(terms) // 64)), np.uint64)
        for i, t in enumerate(terms.tolist()):
            bits[self.docs[self.first[t]:self.first[t + 1]], i // 64] |= np.uint64(1 << i % 64)
        found = np.flatnonzero(bits.any(axis=1))
        return found, bits[found]

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of some documents that have terms; `weights` by term, 0 for those not asked for."""
        size = self.bounds[docs + 1] - self.bounds[docs]
        before = np.cumsum(size) - size
        spots = np.arange(before[-1] + size[-1]) - np.repeat(before - self.bounds[docs], size)
        return np.add.reduceat(weights[self.terms[spots]] * self.part[spots], before)


def groups(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct masks, the documents (as places among `masks`) by mask, and where each mask's begin."""
    if masks.shape[1] == 1:
        distinct, which = np.unique(masks[:, 0], return_inverse=True)
        distinct = distinct[:, None]
    else:
        distinct, which = np.unique(masks, axis=0, return_inverse=True)
    order = np.argsort(which.ravel(), kind="stable")
    return distinct, order, np.searchsorted(which.ravel()[order], np.arange(len(distinct) + 1))


def bounds_of(masks: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The greatest score that a document of each mask can have; `most` by bit."""
    out = np.zeros(len(masks), np.int64)
    for i, value in enumerate(most.tolist()):
        out += (masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).astype(np.int64) * value
    return out


class Best:
    """The best documents of one item so far."""

    def __init__(self, top: int):
        self.top, self.rows = top, []

    @property
    def least(self) -> int:
        """A score below this one can't enter."""
        return self.rows[-1][0] if len(self.rows) == self.top else 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        rows = self.rows + [(s, i) for s, i in zip(scores.tolist(), ids) if s >= self.least]
        self.rows = heapq.nsmallest(self.top, rows, key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))


def search(block: Block, ids: pa.Array, terms: np.ndarray, weights: np.ndarray, best: Best, at_once: int = AT_ONCE) -> int:
    """Add a block's best documents for one item, whose distinct terms and their weights these are; how many were scored."""
    most = weights * block.most[terms]
    terms, weights, most = terms[most > 0], weights[most > 0], most[most > 0]
    if not len(terms) or most.sum() < best.least:
        return 0
    found, masks = block.masks(terms)
    distinct, order, first = groups(masks)
    bound = bounds_of(distinct, most)
    by_term = np.zeros(len(block.most), np.int64)
    by_term[terms] = weights
    scored, waiting = 0, []
    ranked = np.argsort(-bound, kind="stable").tolist()
    for place, mask in enumerate(ranked):
        if bound[mask] < best.least:
            break
        waiting.append(order[first[mask]:first[mask + 1]])
        if sum(map(len, waiting)) >= at_once or place + 1 == len(ranked) or bound[ranked[place + 1]] < best.least:
            docs = found[np.concatenate(waiting)]
            scores = block.scores(docs, by_term)
            enough = np.flatnonzero(scores >= best.least)
            best.add(scores[enough], ids.take(pa.array(docs[enough])).to_pylist())
            scored, waiting = scored + len(docs), []
    return scored


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with a bounded number of postings."""
    part = np.cumsum(np.diff(batch.column("terms").offsets.to_numpy())) // BLOCK_POSTINGS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


def ranked(found: DataFrame, items: list[tuple[object, Counter]], count: int, weights: np.ndarray, documents: int, length: int,
           top: int = TOP) -> DataFrame:
    """(item, doc_id, score): at most `top` rows for each task and item; `item` is the place in `items`."""
    asked = [(np.array(sorted(t), np.int64), np.array([t[x] for x in sorted(t)], np.int64)) for _, t in items]
    shared = found.sparkSession.sparkContext.broadcast((asked, weights))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = shared.value
        best = [Best(top) for _ in asked]
        for batch in (b for whole in batches for b in _blocks(whole)):
            terms, at = batch.column("terms"), batch.column("terms").offsets.to_numpy().astype(np.int64)
            block = Block(batch.column("n").to_numpy(), at - at[0], terms.flatten().to_numpy().astype(np.int64),
                          batch.column("tf").flatten().to_numpy().astype(np.int64), count, documents, length)
            for (mine, times), rows in zip(asked, best):
                search(block, batch.column("doc_id"), mine, weights[mine] * times, rows)
        rows = [(i, d, s) for i, b in enumerate(best) for s, d in b.rows]
        if rows:
            item, ids, score = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, kind_of_id), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    kind = found.schema["doc_id"].dataType
    kind_of_id = to_arrow_type(kind)
    schema = StructType([StructField("item", IntegerType()), StructField("doc_id", kind), StructField("score", LongType())])
    return found.mapInArrow(made, schema)


def best_documents(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): for every item its `top` documents with a score above 0, best first."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    total = asked.select(F.sum(F.size(native_words(F.col("text"))).cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-total // block_terms))
    block, out = F.pmod(F.xxhash64("text"), F.lit(blocks)), None
    names = StructType([StructField("item", IntegerType()), asked.schema["item_id"]])
    for i in range(blocks):
        rows = asked.where(block == i).collect()  # about block_terms terms
        words = [split_words(r.text.encode()) for r in rows]
        number = {w: n for n, w in enumerate(sorted({w for x in words for w in x}))}
        found = written(postings(docs, Terms(list(number)), doc_id, text), "postings")
        documents, length = found.agg(F.count("*"), F.sum("n")).first()
        df = dict(found.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # one row for each term asked for
        weights = np.array([weight(documents, df.get(t, 0)) for t in range(len(number))], np.int64)
        best = ranked(found, [(r.item_id, Counter(number[w] for w in x)) for r, x in zip(rows, words)], len(number), weights, documents, length or 1, top)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        ids = spark.createDataFrame([(n, r.item_id) for n, r in enumerate(rows)], names)
        best = best.join(F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        if blocks > 1:
            best = written(best, "best")
        out = best if out is None else out.unionByName(best)
    return out


def op13_masks(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return best_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '{WORD_PATTERN}') AS w FROM documents),
held AS (SELECT r, doc_id, len(w)::BIGINT AS n, w FROM docs WHERE len(w) > 0),
whole AS (SELECT count(*)::BIGINT AS documents, sum(n)::BIGINT AS length FROM held),
tfs AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM held) GROUP BY r, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1)))::BIGINT AS weight
    FROM tfs, whole GROUP BY term),
items AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all({_LOWERED}, '{WORD_PATTERN}') AS w FROM benchmark),
asked AS (SELECT q, item_id, unnest(w) AS term FROM items),
lengths AS (SELECT r, doc_id, 100 - 75 + ((75 * n * documents) // length) AS m FROM held, whole),
scored AS (
    SELECT q, item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (r) GROUP BY q, item_id, r, doc_id),
ranks AS (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranks WHERE rank <= 10
"""
