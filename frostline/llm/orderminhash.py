"""Near-duplicate documents by Order MinHash, verified by banded alignment.

The k-mers of a text are its runs of five words, labelled with how often the run came before. For each of `SKETCHES`
hash functions the `KEPT` labelled k-mers with the smallest values are taken and put in text order: texts share a
sketch when they share those k-mers in that order, which follows their edit similarity. Texts that share a sketch are
compared with the smallest and the largest of them first.

Texts of sketches that still lie in several components are compared further, by what similarity needs: two texts whose
k-mers agree to `LEAST` share one of their rarest ones, rarest among these texts, as few as `prefixes` tells. Texts with
a passage in common and words of their own otherwise share no such k-mer and never meet. Of the texts that share one, some, those with most k-mers that others have too, are compared with all of
other components, `GROWTH` times as many in each round, until no two such texts are in different components without having been
compared. No pair of these texts that is similar is left out.

A candidate is a near duplicate when its five-word runs agree to `LEAST` (Jaccard, counted with repeats) and an
alignment inside a band of diagonals, as wide as that similarity allows, keeps the same share of the longer text's words.
At the limit of 0.8 a pair shares one of 16 sketches with probability 1 - 10**-5, at 0.7 still 0.998.

Words are runs of letters and digits, A-Z lower-cased. Equal texts are one node and always of one class. Texts of one to
four words have one k-mer, all of them. A null text, and a text without words that no other text equals, is a class of
its own. Classes are named by their smallest doc_id. Repeated rows are members as often as they come. An empty table
gives no row. Only the named columns are read; the stage returns its input's columns, whatever their names.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from frostline.llm.components import components
from frostline.llm.text import Scratch, hashed_words, mix, shingles, small_slices, text_key, written

K, SKETCHES, KEPT, LEAST = 5, 16, 3, 0.8
#: How many times more texts of a group each round compares with the others.
GROWTH = 16
#: Texts of a group that are all compared with each other from the third round on.
AT_ONCE = 2048
_PLACE = np.uint64((1 << 24) - 1)
_NONE = np.uint64(2**64 - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def kmers(hashes: np.ndarray, bounds: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """K-mers of rows of words; a row of fewer words, but not none, is one k-mer."""
    runs, ends = shingles(hashes, bounds, k)
    counts = np.diff(bounds)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = [np.bitwise_xor.reduce(mix(hashes[bounds[r]:bounds[r + 1]] + np.arange(counts[r], dtype=np.uint64))) for r in short]
        runs = np.insert(runs, ends[short], mix(np.array(whole, np.uint64)))
        ends = ends + np.concatenate([[0], np.cumsum((counts > 0) & (counts < k))])
    return runs, ends


def labelled(runs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each k-mer mixed with the number of equal ones before it in its row."""
    row = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    inside = mix(runs + row * _ODD)
    ordered = np.sort(inside)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    number = np.zeros(len(runs), np.uint64)
    if len(twice):
        marks = np.zeros(1 << 22, bool)
        marks[twice & np.uint64(marks.size - 1)] = True
        spots = np.flatnonzero(marks[inside & np.uint64(marks.size - 1)])
        spots = spots[np.argsort(inside[spots], kind="stable")]
        first = np.r_[True, inside[spots][1:] != inside[spots][:-1]]
        start = np.maximum.accumulate(np.where(first, np.arange(len(spots)), 0))
        number[spots] = np.arange(len(spots)) - start
    return mix(runs + number * _ODD)


def sketch(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of SKETCHES numbers for each row with words, in their order."""
    runs, ends = kmers(hashes, bounds)
    starts = ends[:-1][np.diff(ends) > 0]
    if not len(starts):
        return np.zeros((0, SKETCHES), np.uint64)
    names = labelled(runs, ends)
    sizes = np.diff(ends)[np.diff(ends) > 0]
    place = (np.arange(len(runs)) - np.repeat(starts, sizes)).astype(np.uint64) & _PLACE
    out = np.empty((len(starts), SKETCHES), np.uint64)
    for j in range(SKETCHES):
        value = mix(names + np.uint64((j + 1) * int(_ODD) % 2**64))
        value = (value & ~_PLACE) | place
        taken = np.empty((KEPT, len(starts)), np.uint64)
        for i in range(KEPT):
            least = np.minimum.reduceat(value, starts)
            there = least != _NONE
            taken[i] = np.where(there, least & _PLACE, _NONE)
            value[starts[there] + (least[there] & _PLACE).astype(np.int64)] = _NONE
        taken.sort(axis=0)
        key = np.full(len(starts), np.uint64(j))
        for at in taken:
            there = at != _NONE
            run = np.where(there, runs[np.where(there, starts + np.where(there, at, 0).astype(np.int64), 0)], np.uint64(0))
            key = mix(key * _ODD + run)
        out[:, j] = key
    return out


def _texts_nodes(held: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, a, b, n, s0, s1, ...) of every different text with words: a number, its key, its k-mers and its sketches."""
    names = [f"s{j}" for j in range(SKETCHES)]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text"):
                hashes, bounds = hashed_words(batch.column("text"))
                found = sketch(hashes, bounds).view(np.int64)
                words = np.diff(bounds)
                rows, n = pa.array(np.flatnonzero(words)), pa.array(np.maximum(words[words > 0] - K + 1, 1).astype(np.int64))
                columns = [batch.column("a").take(rows), batch.column("b").take(rows), n, *(pa.array(np.ascontiguousarray(c)) for c in found.T)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "n", *names])

    kind = ", ".join(f"{c} bigint" for c in ("a", "b", "n", *names))
    found = held.select("a", "b", "text").where("a IS NOT NULL").mapInArrow(made, kind)
    # Copies have the same numbers, so the smallest of each is theirs; a task's copies are one row before the shuffle.
    found = found.groupBy("a", "b").agg(*[F.min(c).alias(c) for c in ("n", *names)])
    return scratch.written(found.withColumn("id", F.monotonically_increasing_id()), "nodes")


def candidates(nodes: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (x, y), every text with the smallest and the largest that shares one of its sketches; and
    (sketch, id) of the sketches of three texts or more, which may have other pairs.
    """
    rows = nodes.select("id", F.explode(F.array(*[f"s{j}" for j in range(SKETCHES)])).alias("sketch"))
    ends = rows.groupBy("sketch").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("size")).where("low <> high")
    # Written, so that adaptive execution sees two plain tables and can split a sketch that very many texts have.
    ends = scratch.written(ends, "ends")
    met = rows.join(ends, "sketch")
    pairs = met.select("id", F.explode(F.array("low", "high")).alias("other")).where("id <> other")
    pairs = pairs.select(F.least("id", "other").alias("x"), F.greatest("id", "other").alias("y")).distinct()
    return scratch.written(pairs, "pairs"), scratch.written(rows.join(ends.where("size > 2").select("sketch"), "sketch"), "several")


def unsettled(rows: DataFrame, by: str, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of the groups `by` that have texts of several components, with `root`."""
    named = rows.drop("root").join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id")).drop("node")
    named = scratch.written(named, "named")
    meets = F.max("indexed") if "indexed" in rows.columns else F.lit(True)
    several = named.groupBy(by).agg(F.min("root").alias("low"), F.max("root").alias("high"), meets.alias("meets")).where("low <> high AND meets").select(by)
    return scratch.written(named.join(scratch.written(several, "several"), by), "open")


def prefixes(texts: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(name, id, n, shared, indexed) and (id, names, index) of the labelled k-mers by which a text meets every other of these that is similar: rarest
    first, as many as similarity leaves room for; k-mers that no other text has are counted but meet nobody. `shared` is
    how many of a text's others have too; `names` and `index` are all of its names, and those that are indexed.

    Two texts of n <= m k-mers that agree to LEAST have a k-mer among the shorter one's n - ceil(2 LEAST / (1 + LEAST) n) + 1
    rarest, which are `indexed`, and the longer one's m - ceil(LEAST * m) + 1 rarest.
    """
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text"):
                runs, ends = kmers(*hashed_words(batch.column("text")))
                names = pa.array(labelled(runs, ends).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), names)], ["id", "names"])

    each = texts.select("id", "text").mapInArrow(made, "id bigint, names array<bigint>")
    each = scratch.written(each.select("id", F.size("names").cast("bigint").alias("n"), F.explode("names").alias("name")), "names")
    counts = scratch.written(each.groupBy("name").agg(F.count("*").alias("c")).where("c > 1"), "counts")
    shared = each.join(counts, "name")
    own = Window.partitionBy("id")
    placed = shared.withColumns({"at": F.row_number().over(own.orderBy("c", "name")), "shared": F.count("*").over(own)})
    room, inner = (F.col("shared") + 1 - F.ceil(F.col("n") * share - 1e-9) for share in (LEAST, 2 * LEAST / (1 + LEAST)))
    kept = placed.where(F.col("at") <= room).groupBy("id", "n", "shared").agg(
        F.collect_list("name").alias("names"), F.collect_list(F.when(F.col("at") <= inner, F.col("name"))).alias("index"))
    kept = scratch.written(kept, "kept")
    rows = kept.select("id", "n", "shared", "index", F.explode("names").alias("name")).withColumn("indexed", F.array_contains("index", F.col("name")))
    return scratch.written(rows.drop("index"), "prefixes"), kept.select("id", "names", "index")


def _first_common(one: tuple[str, str, str], other: tuple[str, str, str]) -> Column:
    """The smallest k-mer by which two texts meet, from (n, names, index) of both; a pair is compared where that one is."""
    (n, names, index), (m, their_names, their_index) = one, other
    return F.array_min(F.when(F.col(n) < F.col(m), F.array_intersect(index, their_names)).when(
        F.col(n) > F.col(m), F.array_intersect(names, their_index)).otherwise(F.array_intersect(index, their_index)))


def linked(nodes: DataFrame, texts_of: Callable[[DataFrame], DataFrame], scratch: Scratch) -> DataFrame:
    """(node, root) of the components of all near duplicates among the texts that share sketches.

    `texts_of` gives (id, text) for numbers of texts. A pair is left out only when its texts are in one component already,
    or when it can't be similar by the k-mers that the two have.
    """
    checked, rows = candidates(nodes, scratch)
    texts = scratch.written(texts_of(checked.select(F.explode(F.array("x", "y")).alias("id")).distinct()), "texts")
    roots = components(verified(checked, texts), "x", "y", scratch)
    rows = unsettled(rows, "sketch", roots, scratch)
    if not rows.limit(1).count():
        return roots
    met = texts.join(rows.select("id").distinct(), "id", "left_semi")
    rows, held = prefixes(met, scratch)
    rows, salts = scratch.written(unsettled(rows, "name", roots, scratch).join(held, "id"), "open"), 1
    while rows.limit(1).count():
        sizes = rows.groupBy("name").agg(F.count("*").alias("size"))
        whole = (F.col("size") <= AT_ONCE) & F.lit(salts > GROWTH)  # what is left of smaller groups is compared in one round
        part = F.when(whole, F.col("id")).otherwise(F.pmod(F.xxhash64("id", F.lit(salts)), F.lit(salts)))
        chosen = rows.join(sizes, "name").groupBy("name", whole.alias("whole"), part).agg(F.max_by("id", "shared").alias("id"))
        about = rows.select("name", "id", *[F.col(c).alias(f"pivot_{c}") for c in ("n", "root", "names", "index")])
        chosen = scratch.written(chosen.select("name", "whole", "id").join(about, ["name", "id"]).withColumnRenamed("id", "pivot"), "pivots")
        once = ~F.col("whole") | (F.col("id") < F.col("pivot"))  # where all are chosen, a pair would meet twice
        met = once & (F.col("root") != F.col("pivot_root")) & (F.least("n", "pivot_n") >= LEAST * F.greatest("n", "pivot_n")) & (
            F.col("rows.name") == _first_common(("n", "names", "index"), ("pivot_n", "pivot_names", "pivot_index")))
        pairs = rows.alias("rows").join(chosen.alias("chosen"), (F.col("rows.name") == F.col("chosen.name")) & met)
        pairs = pairs.select(F.least("id", "pivot").alias("x"), F.greatest("id", "pivot").alias("y")).distinct()
        pairs = scratch.written(pairs.join(checked, ["x", "y"], "left_anti"), "pairs")
        checked = checked.unionByName(pairs)
        links = verified(pairs, texts).unionByName(roots.select(F.col("node").alias("x"), F.col("root").alias("y")))
        roots = components(links, "x", "y", scratch)
        done = chosen.select(F.col("name").alias("_n"), F.col("pivot").alias("_i"))
        left = rows.join(done, (F.col("name") == F.col("_n")) & (F.col("id") == F.col("_i")), "left_anti")
        rows = unsettled(left, "name", roots, scratch)
        salts *= GROWTH
    return roots


def aligned(x: list, y: list, most: int) -> int | None:
    """Words that an alignment of fewest insertions and deletions matches; None if it needs more than `most`.

    Only diagonals within `most` of the start's are walked: for each number of edits, the furthest point on each.
    """
    n, m = len(x), len(y)
    if abs(n - m) > most:
        return None
    reach = {1: 0}
    for edits in range(most + 1):
        for d in range(-edits, edits + 1, 2):
            down = d == -edits or (d != edits and reach.get(d - 1, -1) < reach.get(d + 1, -1))
            i = reach.get(d + 1, -1) if down else reach.get(d - 1, -1) + 1
            if i < 0 or i > n or i - d > m or i - d < 0:
                reach[d] = -1 if i < 0 or i - d < 0 else min(i, n, m + d)
                if reach[d] < 0:
                    continue
                i = reach[d]
            j = i - d
            while i < n and j < m and x[i] == y[j]:
                i += 1
                j += 1
            reach[d] = i
            if i >= n and j >= m:
                return (n + m - edits) // 2
    return None


def similar(x: np.ndarray, y: np.ndarray, least: float = LEAST) -> bool:
    """Whether two texts, as arrays of word hashes, are near duplicates."""
    if len(x) == len(y) and (x == y).all():
        return True
    runs = [kmers(w, np.array([0, len(w)]))[0] for w in (x, y)]
    names = [np.sort(labelled(r, np.array([0, len(r)]))) for r in runs]
    shared = len(np.intersect1d(*names, assume_unique=True))
    if shared < least * (len(names[0]) + len(names[1]) - shared):
        return False
    head = int(np.argmin(np.r_[x[:len(y)] == y[:len(x)], False]))
    x, y, n = x[head:], y[head:], max(len(x), len(y))
    tail = int(np.argmin(np.r_[x[::-1][:len(y)] == y[::-1][:len(x)], False]))
    x, y = x[:len(x) - tail].tolist(), y[:len(y) - tail].tolist()
    matched = aligned(x, y, int(len(x) + len(y) + 2 * (head + tail) - 2 * least * n))
    return matched is not None and head + tail + matched >= least * n


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (x, y) whose texts are near duplicates; `texts` has (id, text)."""
    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "tx"):
                sides = [hashed_words(batch.column(c)) for c in ("tx", "ty")]
                kept = [i for i in range(batch.num_rows) if similar(*(h[b[i]:b[i + 1]] for h, b in sides))]
                yield batch.select(["x", "y"]).take(pa.array(kept, pa.int64()))

    both = pairs.join(texts.select(F.col("id").alias("x"), F.col("text").alias("tx")), "x").join(
        texts.select(F.col("id").alias("y"), F.col("text").alias("ty")), "y")
    return both.select("x", "y", "tx", "ty").mapInArrow(checked, "x bigint, y bigint")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, class_id, class_size, n_texts) for every row: its class and how many rows and texts that has."""
    held = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    held = held.withColumn("key", text_key(F.col("text"))).select("doc_id", "text", "key.a", "key.b")
    scratch = Scratch(docs.sparkSession, "orderminhash")
    rows = written(held.select("doc_id", "a", "b"), "keys")
    nodes = _texts_nodes(held, scratch)

    def texts_of(ids: DataFrame) -> DataFrame:
        asked = nodes.select("id", "a", "b").join(ids, "id")
        firsts = rows.where("a IS NOT NULL").groupBy("a", "b").agg(F.min("doc_id").alias("d")).join(asked, ["a", "b"])
        firsts = firsts.select("id", F.col("a").alias("_a"), F.col("b").alias("_b"), "d")
        # By document and text, so that copies of one text don't meet in one task.
        same = (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")) & F.col("doc_id").eqNullSafe(F.col("d"))
        return held.join(firsts, same).select("id", "text").dropDuplicates(["id"])

    roots = linked(nodes, texts_of, scratch)
    numbered = rows.join(nodes.select("id", F.col("a").alias("_a"), F.col("b").alias("_b")), (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left")
    marked = numbered.join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id"))
    # A text without words has no number; equal ones are one class.
    marked = marked.select("doc_id", "a", "b", F.coalesce(F.col("root"), -1 - F.pmod("a", F.lit(1 << 62))).alias("root"))
    texts = marked.where("a IS NOT NULL").groupBy("root", "a", "b").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    about = texts.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("n").alias("class_size"), F.count("*").alias("n_texts"))
    named = written(marked.join(scratch.written(about, "classes"), "root", "left"), "classes")
    scratch.close()
    return named.select("doc_id", F.when(F.col("a").isNotNull(), F.struct("a", "b")).alias("key"),
                        F.when(F.col("a").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                        F.when(F.col("a").isNull(), 1).otherwise(F.col("class_size")).alias("class_size"),
                        F.when(F.col("a").isNull(), 1).otherwise(F.col("n_texts")).alias("n_texts"))


def op8_orderminhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return classes(docs).select("doc_id", "class_id", "class_size", "n_texts", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def near_dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the one with the smallest id, once."""
    kept = classes(docs).where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    kept = written(kept.groupBy("doc_id", "key").agg(F.count("*").alias("n")), "kept")
    # The input's columns travel as one, so that their names can't meet the stage's own.
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("d"), text_key(F.col("text")).alias("k"))
    ids = kept.select("doc_id", "key")
    out = own.join(ids, F.col("d").eqNullSafe(F.col("doc_id")) & F.col("k").eqNullSafe(F.col("key")), "left_semi")
    if kept.where("n > 1 AND key IS NOT NULL").limit(1).count():
        out = out.where("k IS NULL").unionByName(out.where("k IS NOT NULL").dropDuplicates(["d", "k"]))
    return out.select("row.*")
