"""Words of texts, hashed in bulk, and the keys under which equal texts meet."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from frostline.workspace import fresh_path, remove

LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
#: A word is a longest run of these, after A-Z became a-z.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _folded(byte: int) -> int:
    """The byte as it stands in a word, or a blank."""
    char = chr(byte).lower() if byte < 0x80 else ""
    return byte if byte >= 0x80 else ord(char) if char in LOWER + "0123456789" else 0x20


_FOLD = bytes(map(_folded, range(256)))
_FOLD_ZERO = np.frombuffer(_FOLD.replace(b" ", b"\0"), np.uint8)
_BASE = 0x9E3779B97F4A7C15
_STEP = 1 << 20


def split_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def native_words(text: Column) -> Column:
    """The words of a text as an array, without Python; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD_PATTERN), F.lit(0))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits; a one-to-one mapping."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for n bytes at least."""
    if not _powers or len(_powers[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(n + _STEP, b, np.uint64)]) for b in (_BASE, inverse)]
    return _powers


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and each row's bounds among them."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    texts = texts.cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[bounds[0]:bounds[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def word_spans(data: np.ndarray, bounds: np.ndarray, fold: np.ndarray = _FOLD_ZERO,
               apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words, where they start and stop, and where each row's words begin (one bound more than rows).

    `fold` gives for each byte what it counts as, 0 outside words; `apart` marks bytes that are words of their own. The
    batch is walked in pieces of about a megabyte that end between words, so memory beside the result is bounded.
    """
    hashes, starts, stops, at = [], [], [], 0
    while at < len(data):
        end = min(at + _STEP, len(data))
        while end < len(data) and fold[data[end]]:
            blank = np.flatnonzero(fold[data[end:end + _STEP]] == 0)
            end = end + int(blank[0]) if len(blank) else min(end + _STEP, len(data))
        piece = fold[data[at:end]]
        inside = piece != 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        rows = bounds[np.searchsorted(bounds, at):np.searchsorted(bounds, end)] - at
        first[rows] = inside[rows]
        if apart is not None:
            alone = apart[at:end]
            first |= alone
            first[1:] |= alone[:-1] & inside[1:]
        start = np.flatnonzero(first)
        last = inside.copy()
        last[:-1] &= ~inside[1:] | first[1:]
        stop = np.flatnonzero(last) + 1
        power, inverse = _power_tables(len(piece))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(piece * power[:len(piece)])])
        hashes.append(mix((total[stop] - total[start]) * inverse[start]))
        starts.append(start + at)
        stops.append(stop + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    starts = np.concatenate(starts)
    return np.concatenate(hashes), starts, np.concatenate(stops), np.searchsorted(starts, bounds)


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch of texts, and where each row's words begin (one bound more than rows)."""
    hashes, _, _, rows = word_spans(*flat_bytes(texts))
    return hashes, rows


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words inside rows, and each row's bounds among them."""
    counts = np.maximum(np.diff(bounds) - k + 1, 0)
    if len(hashes) < k:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    rolled = hashes[:len(hashes) - k + 1].copy()
    for i in range(1, k):
        rolled = mix(rolled * np.uint64(3)) + hashes[i:len(hashes) - k + 1 + i]
    ends = np.concatenate([[0], np.cumsum(counts)])
    index = np.arange(ends[-1]) - np.repeat(ends[:-1], counts) + np.repeat(bounds[:-1], counts)
    return mix(rolled[index]), ends


def text_key(text: Column) -> Column:
    """128 bits that stand for a text: equal texts, equal keys. Null for null."""
    return F.when(text.isNotNull(), F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b")))


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table in the shared folder: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables in the shared folder that one operator needs for a while: they are removed together."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.count = spark, fresh_path(spark, name), 0

    def written(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        remove(self.spark, self.root)


def small_slices(batch: pa.RecordBatch, text: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about `size` bytes of text, so that what is computed beside it stays bounded."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)
