"""Packing documents into training sequences by lexical retrieval.

Documents become token ids and are dealt into shards of about `SHARD_BYTES` of text. Each shard builds a BM25 inverted
index over its documents. A seed opens a sequence; all its terms ask the index for the nearest documents that are
still unused, which fill the sequence one after another. The one that reaches the end is cut there, and its rest is the
next seed. Only the last sequence of a shard is shorter than the window.

Null and empty texts are documents of the end token alone. Equal rows are packed as often as they come and spread over
shards, so many copies of a row don't fill one. A document longer than a window fills windows of its own first. An empty
table gives no row. Only the named columns are read.

Token ids equal those of the tokenizer for the whole text: its pieces never cross white space, so words are looked up
in a bounded memory of words met before, a batch at a time. Texts for which lower-casing first could matter are encoded
whole.
"""

import json
import os
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from frostline.llm.text import flat_bytes, small_slices, word_spans

WINDOW, END = 4096, 2
SHARD_BYTES = 16 << 20
#: BM25's constants; numbers that rows of weights hold, for terms of more than one document in COMMON; neighbours ranked at once.
K1, B, ROWS, COMMON, RANKED = 1.2, 0.75, 4 << 20, 32, 64
#: Words that a worker remembers, by 64-bit hash, and the most bytes of ids of one.
REMEMBERED, LONGEST = 600_000, 64
PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
#: Bytes as they count for words between ASCII blanks, and which of them are letters and digits, commas and full stops.
_BYTES = np.arange(256, dtype=np.uint8)
_FOLD = np.where(np.isin(_BYTES, list(b" \t\n\r\x0b\x0c")), 0, np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES)).astype(np.uint8)
#: How byte-level tokenizers show bytes: printable ones as themselves, the others as the characters from 256 on, in order.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}
_ALNUM = np.isin(_BYTES, list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
#: Second bytes, after C3, of the letters from U+00C0 to U+00FF: all but the signs for times and divided by.
_LATIN = (_BYTES >= 0x80) & (_BYTES <= 0xBF) & ~np.isin(_BYTES, [0x97, 0xB7])
_POINT = np.isin(_BYTES, list(b".,"))


class Words:
    """Token ids of texts, as little-endian unsigned numbers of `dtype`."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[int, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_letters(self, words: list[bytes]) -> list[bytes]:
        """Words of small letters alone are one piece each and pass the tokenizer's first steps unchanged: its model suffices."""
        split, ids, ends = self.tokenizer.model.tokenize, [], [0]
        for word in words:
            shown = word.decode() if word.isascii() else word.decode("latin-1").translate(_SHOWN)
            ids += [t.id for t in split(shown)]
            ends.append(len(ids) * self.dtype.itemsize)
        flat = np.array(ids, self.dtype).tobytes()
        return [flat[a:b] for a, b in zip(ends, ends[1:])]

    def _encode_all(self, words: list[bytes]) -> list[bytes]:
        texts = [w.decode() for w in words]
        letters = [i for i, w in enumerate(texts) if w.isalpha() and w.islower()]
        others = sorted(set(range(len(texts))).difference(letters))
        found = dict(zip(others, self._encode([texts[i] for i in others])))
        found.update(zip(letters, self._encode_letters([words[i] for i in letters])))
        return [found[i] for i in range(len(words))]

    def ids(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, without an end token."""
        data, bounds = flat_bytes(texts)
        hashes, starts, stops, rows = word_spans(data, bounds, _FOLD, _ends_apart(data, bounds))
        which, names = pd.factorize(hashes)  # in order of appearance
        first = np.flatnonzero(np.diff(np.maximum.accumulate(which), prepend=-1))
        names = names.tolist()
        parts = list(map(self.known.get, names))
        new = [i for i, x in enumerate(parts) if x is None]
        if new:
            content = data.tobytes().lower()
            found = self._encode_all([content[starts[first[i]]:stops[first[i]]] for i in new])
            if len(self.known) > REMEMBERED:
                self.known.clear()
            for i, x in zip(new, found):
                parts[i] = x
                if len(x) <= LONGEST:
                    self.known[names[i]] = x
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // self.dtype.itemsize
        begins = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(parts), self.dtype)
        ends = np.concatenate([[0], np.cumsum(sizes[which])])
        spots = np.arange(ends[-1]) - np.repeat(ends[:-1] - begins[which], sizes[which])
        every, cuts = flat[spots], ends[rows].tolist()
        out = [every[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        odd = [i for i, t in enumerate(texts.to_pylist()) if t and not _plain(t)]
        for i, x in zip(odd, self._encode([texts[i].as_py() for i in odd])):
            out[i] = x
        return out


def _plain(text: str) -> bool:
    """Whether lower-casing A-Z first changes nothing: the tokenizer composes letters and looks for its own marks before."""
    if text.isascii():
        return "<|" not in text
    return "<|" not in text and unicodedata.is_normalized("NFC", text.encode().lower().decode())


def _ends_apart(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Commas and full stops between a Latin letter or a digit and a blank: pieces of their own for the tokenizer too."""
    after = np.ones(len(data), bool)
    after[:-1] = _FOLD[data[1:]] == 0
    after[bounds[(bounds > 0)] - 1] = True
    before = np.zeros(len(data), bool)
    before[1:] = _ALNUM[data[:-1]]
    before[2:] |= (data[:-2] == 0xC3) & _LATIN[data[1:-1]]
    before[bounds[bounds < len(data)]] = False
    return _POINT[data] & after & before


_words: dict[int, Words] = {}


def tokenized(docs: DataFrame, tokenizer: str, shards: int, doc_id: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """(shard, doc_id, copy, ids): ids with the end token; copy numbers equal rows of a partition."""
    content = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = hash(content.value)
        if name not in _words:
            _words[name] = Words(content.value)
        words = _words[name]
        last, part, seen = np.array([end], words.dtype).tobytes(), TaskContext.get().partitionId(), Counter()
        for whole in batches:
            for batch in small_slices(whole, "text"):
                doc_ids = batch.column("doc_id").to_pylist()
                ids = [x + last for x in words.ids(batch.column("text"))]
                shard, copy = [], []
                for row in zip(doc_ids, map(zlib.crc32, ids)):
                    copy.append(seen[row])
                    seen[row] += 1
                    shard.append(zlib.crc32(f"{row}/{part if copy[-1] else ''}/{copy[-1]}".encode()) % shards)
                columns = [pa.array(shard, pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(copy, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "doc_id", "copy", "ids"])

    held = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return held.mapInArrow(made, "shard bigint, doc_id bigint, copy bigint, ids binary")


class Index:
    """BM25 over the token ids of a shard's documents."""

    def __init__(self, docs: list[np.ndarray]):
        sizes = np.array([len(d) for d in docs])
        width = 1 << 32
        owner = np.repeat(np.arange(len(docs), dtype=np.int64), sizes)
        pair, count = np.unique(np.concatenate(docs).astype(np.int64) * width + owner, return_counts=True)
        term, self.docs = pair // width, pair % width
        self.terms, first = np.unique(term, return_index=True)
        self.first = np.append(first, len(term))
        found = np.diff(self.first)
        self.rarity = np.log(1 + (len(docs) - found + 0.5) / (found + 0.5))
        spread = K1 * (1 - B + B * sizes / max(sizes.mean(), 1))
        self.weight = np.repeat(self.rarity, found) * count * (K1 + 1) / (count + spread[self.docs])
        self.n = len(docs)
        common = np.argsort(-found, kind="stable")[:ROWS // self.n]
        common = common[found[common] * COMMON > self.n]
        self.row = np.full(len(self.terms), -1)
        self.row[common] = np.arange(len(common))
        self.common = np.zeros((len(common), self.n))
        for row, t in enumerate(common):
            held = slice(self.first[t], self.first[t + 1])
            self.common[row, self.docs[held]] = self.weight[held]

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Every document's BM25 for all terms of `ids` that several documents have."""
        at = np.searchsorted(self.terms, np.unique(ids))
        first, size = self.first[at], np.diff(self.first)[at]
        row = self.row[at]
        few = (row < 0) & (size > 1)
        first, size = first[few], size[few]
        spots = np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)
        score = np.bincount(self.docs[spots], self.weight[spots], self.n).astype(np.float64)
        for i in row[row >= 0]:
            score += self.common[i]
        return score

    def neighbours(self, ids: np.ndarray, unused: np.ndarray) -> Iterator[int]:
        """Unused documents that share a term of `ids`, best first."""
        score = self.scores(ids)
        found = np.flatnonzero((score > 0) & unused)
        score = score[found]
        while len(found) > RANKED:  # a sequence needs a few, so the others are ranked when they are asked for
            least = np.partition(score, len(score) - RANKED)[len(score) - RANKED]
            top = score >= least
            yield from found[top][np.argsort(-score[top], kind="stable")].tolist()
            found, score = found[~top], score[~top]
        yield from found[np.argsort(-score, kind="stable")].tolist()


def pack(docs: list[np.ndarray], window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length); every token is in one of them."""
    if not docs:
        return
    index, unused = Index(docs), np.ones(len(docs), bool)
    now: list[tuple[int, int, int]] = []
    room, fresh, queue = window, 0, iter(())
    while True:
        doc = next((d for d in queue if unused[d]), None)
        if doc is None:
            while fresh < len(docs) and not unused[fresh]:
                fresh += 1
            if fresh == len(docs):
                break
            doc = fresh
        unused[doc] = False
        if not now:
            queue = index.neighbours(docs[doc], unused)
        start, size = 0, len(docs[doc])
        while size - start >= room:
            yield [*now, (doc, start, room)]
            start, now, room = start + room, [], window
        if start < size:
            if start:  # the rest of a document that was cut is the next seed
                queue = index.neighbours(docs[doc], unused)
            now.append((doc, start, size - start))
            room -= size - start
    if now:
        yield now


def packed(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
           shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Pieces: doc_id, start, length, ids (unsigned 32-bit little-endian), doc_tokens, sequence_id and offset."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    dtype = "<u2" if len(json.loads(tokenizer)["model"]["vocab"]) <= 60_000 else "<u4"

    def shard(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("copy", "ascending"), ("ids", "ascending")])
        doc_ids, number = table.column("doc_id").to_pylist(), table.column("shard")[0].as_py()
        ids = [np.frombuffer(x.as_buffer(), dtype) for x in table.column("ids")]
        rows = []
        for n, pieces in enumerate(pack(ids, window)):
            offset = 0
            for doc, start, length in pieces:
                part = ids[doc][start:start + length].astype("<u4").tobytes()
                rows.append((doc_ids[doc], start, length, part, len(ids[doc]), (number << 32) + n, offset))
                offset += length
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SCHEMA.types)], schema=_SCHEMA)

    return tokenized(docs, tokenizer, shards, doc_id, text).groupBy("shard").applyInArrow(shard, PIECES)


def word_tokenizer() -> str:
    with open(public_tokenizers.path("word_bpe_49k.json")) as file:
        return file.read()


def op6_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return packed(docs, word_tokenizer()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences with their token ids."""
    return packed(docs, word_tokenizer()).withColumn("ids_crc32", F.crc32("ids"))
