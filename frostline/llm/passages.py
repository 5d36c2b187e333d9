"""Passages that documents share, exactly or nearly, by collinear chaining of k-mer seeds.

Seeds are runs of `K` words, of which each `WINNOW` consecutive ones keep the one with the smallest hash: texts that
share WINNOW + K - 1 words in a row share a seed. Runs of `LEAST_WORDS` words are seeds too, chosen in the same way: two
texts that share WINNOW + LEAST_WORDS - 1 = 51 words in a row have such a seed, and its owner shares a whole passage with
every text that has it, whoever owns the shorter seeds inside. A seed's owner is the smallest of the texts that have it. Every other
text is matched with owners only, so matches grow with the seeds, not with pairs of texts. An owner's first place of a
seed counts; its later ones are matched with the first as those of another text, so that its own repeats are found. The matches of a text with
one owner are chained: a Fenwick tree finds for each match, in text order, the best chain that ends before it in both
texts, less a cost for each word skipped. Chains become passages when an alignment of the words between their ends,
lengthened word by word with room for small edits, keeps `LEAST` of the words over `LEAST_WORDS` or more. A chain that
doesn't is parted where most words are lost between two of its matches, and each part is tried again. A text and an
owner are one row with all their chains, best first, so that each text travels once for a pair. Chains whose words, and
WINNOW more on either side, passages of the pair already cover are not aligned again: 51 common words in a row are still
covered whole, and a line that a text has a thousand times isn't listed a thousand times over the same words.

Words are runs of letters and digits, A-Z lower-cased. Equal texts are one text: of its documents the first holds it
and all of the others' words repeat it; its passages are listed for the first. A text owns what no smaller text has, so one
occurrence always stays. Null texts and texts of fewer words have no passages. Repeated rows of one document and text are
one; an empty table gives no row.
A text is known by a 64-bit hash while seeds are joined; the alignment rules out what meets by chance.
"""

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from frostline.llm.orderminhash import aligned
from frostline.llm.text import _FOLD_ZERO, Scratch, flat_bytes, hashed_words, mix, shingles, small_slices, word_spans, written

K, WINNOW, LEAST_WORDS, LEAST = 5, 12, 40, 0.8
#: Cost of a skipped word in either text, in matches; fewest matches of a chain; most words that a lengthening adds, and
#: that an edit on its way has.
SKIP, LEAST_MATCHES, STRETCH, REACH = 1 / 60, 2, 64, 4
#: Places inside a seed of LEAST_WORDS words that count as matches, near enough to be one chain.
_INSIDE = (0, (LEAST_WORDS - K) // 2, LEAST_WORDS - K)
#: Texts that a task remembers so as not to read copies again.
_SEEN = 1_000_000
_PLACE = np.uint64((1 << 24) - 1)


def winnowed(runs: np.ndarray, ends: np.ndarray, window: int = WINNOW) -> np.ndarray:
    """Positions among `runs` that are the smallest of some window inside their row; of a short row, its smallest."""
    if not len(runs):
        return np.zeros(0, np.int64)
    value = (runs & ~_PLACE) | np.arange(len(runs), dtype=np.uint64) & _PLACE
    counts = np.diff(ends)
    starts = ends[:-1][counts > 0]
    least = value.copy()
    width = 1
    while width < window:
        step = min(width, window - width)
        least[:len(least) - step] = np.minimum(least[:len(least) - step], least[step:])
        width += step
    row_end = np.repeat(ends[1:], counts)
    whole = np.arange(len(runs)) + window <= row_end
    short = np.minimum.reduceat(value, starts)[counts[counts > 0] < window]
    spots = np.unique(np.concatenate([least[whole] & _PLACE, short & _PLACE])).astype(np.int64)
    return spots


def lengthened(runs: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of LEAST_WORDS words inside rows from those of K words, and each row's bounds among them."""
    counts = np.maximum(np.diff(ends) - (LEAST_WORDS - K), 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    if not bounds[-1]:
        return np.zeros(0, np.uint64), bounds
    size = K
    while size < LEAST_WORDS:
        step = min(size, LEAST_WORDS - size)
        runs, size = mix(runs[:-step] * np.uint64(3)) + runs[step:], size + step
    return mix(runs[np.arange(bounds[-1]) - np.repeat(bounds[:-1], counts) + np.repeat(ends[:-1], counts)]), bounds


def seeds(texts: DataFrame) -> DataFrame:
    """(seed, a, pos) of every text; pos is -1 - position where the text had that seed before. Seeds of LEAST_WORDS words
    are odd numbers, those of K words even ones.
    """
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for batch in small_slices(whole, "text", 2 << 20):
                if len(seen) > _SEEN:
                    seen.clear()
                names = batch.column("a").to_pylist()
                new = [i for i, a in enumerate(names) if not (a in seen or seen.add(a))]
                batch = batch.take(pa.array(new, pa.int64()))
                runs, ends = shingles(*hashed_words(batch.column("text")), K)
                found = []
                for odd, (r, e) in enumerate([(runs, ends), lengthened(runs, ends)]):
                    at = winnowed(r, e)
                    row = np.searchsorted(e, at, "right") - 1
                    found.append((row, at - e[row], r[at] & ~np.uint64(1) | np.uint64(odd)))
                row, pos, seed = (np.concatenate(c) for c in zip(*found))
                order = np.lexsort((pos, seed, row))
                again = np.zeros(len(row), bool)
                again[order[1:]] = (seed[order[1:]] == seed[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
                names = batch.column("a").to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seed.view(np.int64)), pa.array(names[row]), pa.array(np.where(again, -1 - pos, pos).astype(np.int32))], ["seed", "a", "pos"])

    return texts.select("a", "text").mapInArrow(made, "seed bigint, a bigint, pos int")


def matches(found: DataFrame, work: Scratch) -> DataFrame:
    """(a, owner, spots): positions in a text and in the owner of the seeds they share, and which are long ones."""
    owners = found.where("pos >= 0").groupBy("seed").agg(
        F.min("a").alias("owner"), F.max("a").alias("_top"), F.min_by("pos", "a").alias("o"))
    # Written, so that adaptive execution sees two plain tables and can split a seed that very many texts have.
    owners = work.written(owners.where("owner <> _top").drop("_top"), "owners")
    met = found.join(owners, "seed").where("a <> owner OR pos < 0")
    place = F.when(F.col("pos") < 0, -1 - F.col("pos")).otherwise(F.col("pos"))
    spots = met.groupBy("a", "owner").agg(F.sort_array(F.collect_set(F.struct(place.alias("p"), F.col("o"), (F.col("seed") % 2 != 0).alias("long")))).alias("spots"))
    return spots.where((F.size("spots") >= LEAST_MATCHES) | F.exists("spots", lambda s: s["long"]))


def chains(spots: list[tuple[int, int]], skip: float = SKIP) -> list[list[tuple[int, int]]]:
    """Disjoint chains of matches that rise in both texts, best first; a chain begins anew where skipping costs more."""
    spots = sorted(set(spots))
    places = sorted({o for _, o in spots})
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (len(places) + 1)
    score, before, at = [0.0] * len(spots), [-1] * len(spots), 0
    while at < len(spots):
        end = at
        while end < len(spots) and spots[end][0] == spots[at][0]:
            p, o = spots[end]
            i, best = bisect_left(places, o), (-1e18, -1)
            while i > 0:  # the best of all chains that end before o
                best = max(best, tree[i])
                i -= i & -i
            gain = best[0] - skip * (p + o)
            score[end], before[end] = (1.0 + gain, best[1]) if gain > 0 else (1.0, -1)
            end += 1
        for j in range(at, end):  # matches at one place don't follow each other
            p, o = spots[j]
            i, mine = bisect_left(places, o) + 1, (score[j] + skip * (p + o), j)
            while i < len(tree):
                tree[i] = max(tree[i], mine)
                i += i & -i
        at = end
    used, out = [False] * len(spots), []
    for j in sorted(range(len(spots)), key=lambda j: (-score[j], j)):
        chain = []
        while j >= 0 and not used[j]:
            used[j] = True
            chain.append(spots[j])
            j = before[j]
        if len(chain) >= LEAST_MATCHES:
            out.append(chain[::-1])
    return out


def stretched(x: np.ndarray, y: np.ndarray, most: int = STRETCH, reach: int = REACH, sure: int = 3) -> tuple[int, int]:
    """How far two texts go on alike: edits of up to `reach` words are passed when `sure` equal words follow."""
    i = j = 0
    n, m = min(len(x), most), min(len(y), most)
    while i < n and j < m:
        if x[i] == y[j]:
            i, j = i + 1, j + 1
            continue
        for total in range(1, reach + 1):
            step = next(((d, total - d) for d in range(total + 1)
                         if i + d + sure <= n and j + total - d + sure <= m
                         and (x[i + d:i + d + sure] == y[j + total - d:j + total - d + sure]).all()), None)
            if step:
                break
        else:
            break
        i, j = i + step[0], j + step[1]
    return i, j


def passage(x: np.ndarray, y: np.ndarray, chain: tuple[int, int, int, int], shift: int | None = None) -> tuple[int, int, int, int, int] | None:
    """Start and end in `x` and `y` (word hashes) and words matched, or None when too short or too different.

    `chain`: first and last match, positions in x and y. `shift` is given when both are of one text: what is added to a
    place in x to have it in y; the passage in y then ends before that in x.
    """
    p, o, q, r = chain
    for reach in (REACH, 0):  # edits that were passed on the way can cost the share; equal words alone don't
        left = stretched(x[:p][::-1], y[:o][::-1], reach=reach)
        before = y if shift is None else y[:p - left[0] + shift]
        if r + K > len(before):
            continue
        right = stretched(x[q + K:], before[r + K:], reach=reach)
        a, b, c, d = p - left[0], q + K + right[0], o - left[1], r + K + right[1]
        least = LEAST * max(b - a, d - c)
        if min(b - a, d - c) < LEAST_WORDS or max(b - a, d - c) - lost(x[a:b], y[c:d]) < least:
            continue
        matched = aligned(x[a:b].tolist(), y[c:d].tolist(), int((b - a) + (d - c) - 2 * least))
        if matched is not None and matched >= least:
            return a, b, c, d, matched
    return None


def lost(x: np.ndarray, y: np.ndarray) -> int:
    """Words of the longer side that no alignment of two runs of words can match, at least."""
    if len(x) == len(y) and (x == y).all():
        return 0
    words, where = np.unique(np.concatenate([x, y]), return_inverse=True)
    common = np.minimum(np.bincount(where[:len(x)], minlength=len(words)), np.bincount(where[len(x):], minlength=len(words)))
    return max(len(x), len(y)) - int(common.sum())


class Cover:
    """Words of a text that are covered, as disjoint stretches in order."""

    def __init__(self):
        self.spans: list[tuple[int, int]] = []

    def add(self, start: int, end: int) -> None:
        first = bisect_left(self.spans, start, key=lambda s: s[1])
        after = bisect_right(self.spans, end, key=lambda s: s[0])
        if first < after:
            start, end = min(start, self.spans[first][0]), max(end, self.spans[after - 1][1])
        self.spans[first:after] = [(start, end)]

    def holds(self, start: int, end: int) -> bool:
        at = bisect_right(self.spans, start, key=lambda s: s[0]) - 1
        return at >= 0 and self.spans[at][1] >= end


def parts(x: np.ndarray, y: np.ndarray, chain: list[tuple[int, int]], shift: int | None = None,
          covered: Callable[[int, int], bool] = lambda start, end: False) -> Iterator[tuple[int, int, int, int, int]]:
    """The passages of a chain: the whole of it, or else those of its parts around the gap that loses most words.

    Parts whose words, and WINNOW more on either side, are `covered` are left out.
    """
    gaps: list[tuple[int, int]] = []
    left = [(0, len(chain) - 1)]
    while left:
        first, last = left.pop()
        if covered(max(chain[first][0] - WINNOW, 0), min(chain[last][0] + K + WINNOW, len(x))):
            continue
        found = passage(x, y, (*chain[first], *chain[last]), shift)
        if found:
            yield found
        elif last > first:
            gaps = gaps or [(lost(x[p:q], y[o:r]), q - p + r - o) for (p, o), (q, r) in zip(chain, chain[1:])]
            cut = max(range(first, last), key=gaps.__getitem__)
            left += [(cut + 1, last), (first, cut)]


_CHAINS = "a bigint, owner bigint, chains array<struct<p:array<int>,o:array<int>>>"
_PLACES = pa.list_(pa.struct([("p", pa.list_(pa.int32())), ("o", pa.list_(pa.int32()))]))


def chained(met: DataFrame) -> DataFrame:
    """(a, owner, chains) for every text and owner with a chain: the places of each one's matches, best chain first."""
    schema = pa.schema([("a", pa.int64()), ("owner", pa.int64()), ("chains", _PLACES)])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for a, owner, spots in zip(*(batch.column(c).to_pylist() for c in ("a", "owner", "spots"))):
                inside = [(s["p"] + i, s["o"] + i) for s in spots for i in (_INSIDE if s["long"] else (0,))]
                found = [dict(zip("po", zip(*chain))) for chain in chains(inside)]
                if found:
                    rows.append((a, owner, found))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return met.mapInArrow(made, _CHAINS)


def _window(places: list[int]) -> tuple[int, int]:
    """The words of a text that passages with matches at these places, in order, can touch."""
    return max(places[0] - STRETCH, 0), places[-1] + K + STRETCH


def _windows(chains: list[dict]) -> tuple[list[tuple[int, int]], list[int]]:
    """The words of a text that any of its chains can touch, as disjoint stretches, and how many lie before each."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(_window(c["p"]) for c in chains):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(high, out[-1][1])
        else:
            out.append((low, high))
    return out, [0, *np.cumsum([high - low for low, high in out]).tolist()]


def _words(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of a batch's texts, and where each row's begin and end; rows of one text in a row share them."""
    names = batch.column(name).to_numpy(zero_copy_only=False)
    new = np.r_[True, names[1:] != names[:-1]]
    hashes, bounds = hashed_words(batch.column("text").take(pa.array(np.flatnonzero(new))))
    at = np.cumsum(new) - 1
    return hashes, bounds[at], bounds[at + 1]


def confirmed(chains: list[dict], words: np.ndarray, other: np.ndarray, same: bool) -> Iterator[tuple[int, int, int, int, int]]:
    """Start and end in a text and in its owner, and words matched, of the passages of their chains.

    `words`: hashes of the text's words around its chains (`_windows`); `other`: of all words of the owner.
    """
    sent, before = _windows(chains)
    cover = Cover()
    for chain in chains:
        (low, high), (start, stop) = _window(chain["p"]), _window(chain["o"])
        at = bisect_right(sent, low, key=lambda s: s[0]) - 1
        skipped = before[at] - sent[at][0]
        x, y = words[low + skipped:min(high + skipped, before[at + 1])], other[start:stop]
        spots = [(p - low, o - start) for p, o in zip(chain["p"], chain["o"])]
        for a, b, c, d, matched in parts(x, y, spots, low - start if same else None, lambda s, e: cover.holds(s + low, e + low)):
            if not cover.holds(a + low, b + low):
                cover.add(a + low, b + low)
                yield a + low, b + low, c + start, d + start, matched


def passages(ends: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, start, end, owner, owner_start, owner_end, matched) for chains, or parts of them, that an alignment confirms.

    `ends`: what `chained` gives; `texts`: a and text, one row for each text. Only the words around a text's chains travel
    to its owner's text, once for each pair.
    """
    names = ["a", "owner", "chains"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text"):
                hashes, begin, end = _words(batch, "a")
                words = []
                for i, found in enumerate(batch.column("chains").to_pylist()):
                    own = hashes[begin[i]:end[i]]
                    words.append(b"".join(own[low:high].tobytes() for low, high in _windows(found)[0]))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(words, pa.binary())], [*names, "words"])

    schema = pa.schema([("a", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("owner", pa.int64()),
                        ("owner_start", pa.int64()), ("owner_end", pa.int64()), ("matched", pa.int64())])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text"):
                hashes, begin, end = _words(batch, "owner")
                rows = []
                for i, row in enumerate(batch.select([*names, "words"]).to_pylist()):
                    words, other = np.frombuffer(row["words"], np.uint64), hashes[begin[i]:end[i]]
                    for a, b, c, d, matched in confirmed(row["chains"], words, other, row["a"] == row["owner"]):
                        rows.append((row["a"], a, b, row["owner"], c, d, matched))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    near = ends.join(texts, "a").select(*names, "text").mapInArrow(cut, _CHAINS + ", words binary")
    owners = texts.select(F.col("a").alias("owner"), "text")
    out = near.join(owners, "owner").select(*names, "words", "text")
    return out.mapInArrow(align, "a bigint, start bigint, end bigint, owner bigint, owner_start bigint, owner_end bigint, matched bigint")


def shared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Passages between texts; for every row of `docs` (doc_id, a, n, first): its text, copies and their first id; and
    (a, text) of every text that has a chain or copies.
    """
    held = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL")
    held = held.withColumn("a", F.xxhash64("text"))
    rows = written(held.select("doc_id", "a"), "rows")
    work = Scratch(docs.sparkSession, "seeds")
    ends = written(chained(matches(work.written(seeds(held), "seeds"), work)), "chains")
    work.close()
    firsts = rows.groupBy("a").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    asked = ends.select(F.explode(F.array("a", "owner")).alias("a")).unionByName(firsts.where("n > 1").select("a")).distinct()
    name = F.concat(F.col("doc_id").isNull().cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    asked = firsts.join(asked, "a").select("a", F.col("first").alias("doc_id")).select("a", name.alias("d"))
    # By document and text, so that copies of one text don't meet in one task; repeated rows do, where the join left them.
    texts = held.select("a", name.alias("d"), "text").join(asked, ["a", "d"], "left_semi")
    texts = written(texts.dropDuplicates(["a", "d"]).select("a", "text"), "texts")
    found = written(passages(ends, texts), "passages")
    return found, written(rows.join(firsts, "a"), "members"), texts


def word_counts(texts: DataFrame) -> DataFrame:
    """(a, n_words) of texts."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text"):
                counts = np.diff(hashed_words(batch.column("text"))[1])
                yield pa.RecordBatch.from_arrays([batch.column("a"), pa.array(counts, pa.int64())], ["a", "n_words"])

    return texts.select("a", "text").mapInArrow(made, "a bigint, n_words bigint")


def copies(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, start, end, other_doc_id, ...) for documents whose whole text another, earlier one has."""
    later = rows.where("n > 1 AND NOT (doc_id <=> first)").select("doc_id", "a", "first").distinct()
    copied = texts.join(later.select("a").distinct(), "a", "left_semi")
    counted = written(word_counts(copied).where(F.col("n_words") >= LEAST_WORDS), "counts")
    met, none = later.join(counted, "a"), F.lit(0).cast("bigint")
    return met.select("doc_id", none.alias("start"), F.col("n_words").alias("end"), F.col("first").alias("other_doc_id"),
                      none.alias("other_start"), F.col("n_words").alias("other_end"), F.col("n_words").alias("matched"))


def op2_passages(spark, sf_dir: str) -> DataFrame:
    """Every occurrence of a shared passage: words [start, end) of a document, and where the other document has them.

    `repeats` is true for the occurrence to drop; the owner's occurrence is listed with false. Copies of one text are
    listed against its first document, which alone lists the text's passages.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found, rows, texts = shared(docs)
    first = rows.select("a", "first").distinct()
    named = found.join(first.select("a", F.col("first").alias("doc_id")), "a").join(
        first.select(F.col("a").alias("owner"), F.col("first").alias("other_doc_id")), "owner")
    named = named.select("doc_id", "start", "end", "other_doc_id", F.col("owner_start").alias("other_start"),
                         F.col("owner_end").alias("other_end"), "matched")
    here, there = ("doc_id", "start", "end"), ("other_doc_id", "other_start", "other_end")
    sides = [F.struct(*[F.col(c).alias(n) for c, n in zip(one + other, here + there)], "matched", F.lit(repeats).alias("repeats"))
             for one, other, repeats in ((here, there, True), (there, here, False))]
    return named.unionByName(copies(rows, texts)).select(F.explode(F.array(*sides)).alias("side")).select("side.*")


def without(docs: DataFrame, spans: DataFrame, text: str = "text") -> DataFrame:
    """`docs` without the word spans of `spans` (a: hash of the text, spans: array of start and end); texts left empty go."""
    schema = docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, text):
                data, bounds = flat_bytes(batch.column(text))
                _, starts, stops, words = word_spans(data, bounds, _FOLD_ZERO)
                raw, texts, kept = data.tobytes(), batch.column(text).to_pylist(), []
                for i, spans in enumerate(batch.column("_spans").to_pylist()):
                    if spans:
                        lo, hi, out, at = words[i], words[i + 1], [], bounds[i]
                        for span in sorted(spans, key=lambda s: (s["start"], s["end"])):
                            first, last = lo + span["start"], min(lo + span["end"], hi)
                            cut_to = starts[last] if last < hi else bounds[i + 1]
                            if cut_to > at:
                                out.append(raw[at:max(starts[first], at)])
                                at = cut_to
                        texts[i] = b"".join([*out, raw[at:bounds[i + 1]]]).decode()
                    if texts[i] is None or not spans or any(c.isalnum() for c in texts[i]):
                        kept.append(i)
                columns = [pa.array(texts, batch.column(c).type) if c == text else batch.column(c) for c in schema.names]
                yield pa.RecordBatch.from_arrays(columns, schema.names).take(pa.array(kept, pa.int64()))

    marked = docs.withColumn("_a", F.xxhash64(text)).join(spans.select(F.col("a").alias("_a"), F.col("spans").alias("_spans")), "_a", "left")
    return marked.drop("_a").mapInArrow(cut, schema)


def substring_dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a smaller text has too; of equal texts the first document stays."""
    found, rows, _ = shared(docs)
    spans = found.groupBy("a").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    later = rows.where("n > 1 AND NOT (doc_id <=> first)").select(F.col("doc_id").alias("_d"), F.col("a").alias("_t")).distinct()
    own = docs.withColumn("_h", F.xxhash64("text"))
    firsts = own.join(later, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_t")), "left_anti").drop("_h")
    return without(firsts, spans).withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)
