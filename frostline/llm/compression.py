"""Quality by compression: which of two dictionaries, from good or from bad text, makes a text smaller.

Two zstandard dictionaries are trained on labelled text. A text is compressed with each, in pieces of `PIECE` bytes so
that the dictionary counts along the whole of a long text. The difference of the sizes, normalised by the text and by
what remained of it, becomes a probability by a logistic fit on other labelled rows; the ratio itself is a third input,
as very repetitive text shrinks to nothing with either dictionary.

Fitting reads a bounded sample: of each class the `fit_rows` documents with the smallest hash of their id, and of each
the first `SAMPLE_CHARS` characters; two thirds train the dictionaries, one third fits the curve. Class shares are
counted over all labels. Scoring reads every text whole.

Null and empty texts score as a text of measures zero does. Repeated labels of a document count as the worst one;
null labels don't count. Without labels of both classes every score is the share of good labels, or 0.5 without any.
Repeated documents score alike; an empty table gives no row. A column called like the result is replaced.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: Documents of each class that a fit reads, and characters of each.
FIT_ROWS, SAMPLE_CHARS = 3000, 16_384
PIECE, DICTIONARY, LEVEL = 2048, 65_536, 3
#: Numbers that `measures` gives; bytes that keep the second of them steady for short texts.
MEASURES, STEADY = 3, 50


@dataclass
class Model:
    """Two dictionaries and a curve; without dictionaries the score is constant."""

    good: bytes = b""
    bad: bytes = b""
    slopes: tuple[float, ...] = (0.0,) * MEASURES
    offset: float = 0.0

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for content in (self.good, self.bad) if self.good and self.bad else ():
            dictionary = zstandard.ZstdCompressionDict(content)
            dictionary.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False))
        return made


def pieces(text: bytes, size: int = PIECE) -> Iterator[memoryview]:
    view = memoryview(text)
    return (view[i:i + size] for i in range(0, len(text), size))


def measures(text: bytes, compressors: list[zstandard.ZstdCompressor]) -> tuple[float, ...]:
    """What the good dictionary saves over the bad one, for each byte and for each compressed byte, and the best ratio."""
    if not text or not compressors:
        return (0.0,) * MEASURES
    good, bad = (sum(len(c.compress(p)) for p in pieces(text)) for c in compressors)
    return (bad - good) / len(text), (bad - good) / (bad + good + STEADY), math.log(min(good, bad) / len(text))


def _dictionary(texts: list[bytes]) -> bytes:
    samples = [bytes(p) for t in texts for p in pieces(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples: their text itself is the dictionary
        return b"".join(samples)[:DICTIONARY]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[tuple[float, ...], float]:
    """Slopes and offset of a weighted logistic curve, by Newton's method with a slight pull to zero."""
    middle, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    rows = np.c_[(x - middle) / scale, np.ones(len(x))]
    fitted = np.zeros(rows.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ fitted, -30, 30)))
        curve = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(len(fitted))
        step = np.linalg.solve(curve, rows.T @ (weight * (y - p)) - 1e-3 * fitted)
        fitted = fitted + step
        if np.abs(step).max() < 1e-9:
            break
    slopes = fitted[:-1] / scale
    return tuple(map(float, slopes)), float(fitted[-1] - slopes @ middle)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        fit_rows: int = FIT_ROWS) -> Model:
    """A model from all labels and a bounded sample of their documents."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.min(label).alias("y"))
    counts = {r.y: r.n for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    prior = np.clip(counts.get(1, 0) / total, 1e-3, 1 - 1e-3) if total else 0.5
    flat = Model(offset=float(np.log(prior / (1 - prior))))
    if len(counts) < 2:
        return flat
    chosen = [r for y in (0, 1) for r in marked.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(fit_rows).collect()]
    rank = {0: 0, 1: 0}
    rows = []
    for r in chosen:
        rows.append((r.id, r.y, rank[r.y] % 3 == 2))
        rank[r.y] += 1
    small = F.broadcast(docs.sparkSession.createDataFrame(rows, "id bigint, y int, curve boolean"))
    sample = docs.select(F.col(doc_id).alias("id"), F.substring(text, 1, SAMPLE_CHARS).alias("t")).where("t <> ''").join(small, "id")
    sample = sample.groupBy("id", "y", "curve").agg(F.max("t").alias("t")).orderBy("id").collect()
    for_dictionary = {y: [r.t.encode() for r in sample if r.y == y and not r.curve] for y in (0, 1)}
    for_curve = [r for r in sample if r.curve]
    if not all(for_dictionary.values()) or len({r.y for r in for_curve}) < 2:
        return flat
    model = Model(_dictionary(for_dictionary[1]), _dictionary(for_dictionary[0]))
    compressors = model.compressors()
    x, y = np.array([measures(r.t.encode(), compressors) for r in for_curve]), np.array([float(r.y) for r in for_curve])
    weight = np.where(y == 1, prior / y.sum(), (1 - prior) / (1 - y).sum()) * len(y)
    model.slopes, model.offset = logistic(x, y, weight)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """`docs` with the probability that a text is good."""
    docs = docs.drop(out)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            x = [measures(v.as_py() or b"", compressors) for v in batch.column(text).cast(pa.large_binary())]
            p = 1 / (1 + np.exp(-np.clip(np.reshape(x, (-1, MEASURES)) @ model.slopes + model.offset, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], [*batch.schema.names, out])

    return docs.mapInArrow(scored, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def fold(doc_id: Column) -> Column:
    """0 for the held-out fifth of documents."""
    return F.crc32(doc_id.cast("string")) % 5


def op5_compression(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = fit(docs, labels.where(fold(F.col("doc_id")) != 0))
    return score(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))
