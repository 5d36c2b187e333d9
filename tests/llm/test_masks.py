"""Ranked search: against plain scoring of all documents, with ties, many terms, several blocks and odd rows."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_samples import tricky  # noqa: F401
from pyspark.sql import functions as F

from frostline.llm import masks
from frostline.llm.text import split_words

ITEMS = "item_id bigint, text string"


def plainly(docs, items, top=10):
    held = [(d, Counter(split_words((t or "").encode()))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    total, df = sum(n for _, _, n in held), Counter(w for _, c, _ in held for w in c)
    out = []
    for item, text in items:
        rows = []
        for d, c, n in held:
            m = 25 + 75 * n * len(held) // total
            score = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m))
                        for w in split_words((text or "").encode()) if w in c)
            if score > 0:
                rows.append((-score, d is None, d, score))
        rows.sort(key=lambda r: (r[0], r[1], 0 if r[2] is None else r[2]))
        out += [(item, k + 1, d, s) for k, (_, _, d, s) in enumerate(rows[:top])]
    return out


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("block_terms", [1_000_000, 40])
def test_equals_plain_scoring(spark, block_terms, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([0, 1, 5, 40, 200])))) for i in range(600)]
    docs += [(i, docs[i % 7][1]) for i in range(600, 640)] + [(3, docs[3][1]), (None, "w9 w10 w11"), (700, None), (701, "Ünï W100")]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 30, 150])))) for i in range(25)]
    items += [(3, items[3][1]), (None, "w5 w9"), (90, None), (91, ""), (92, "unknown words"), (93, "Ünï ÜNÏ w100 w100")]
    found = masks.best_documents(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6),
                                 spark.createDataFrame(items, ITEMS), block_terms=block_terms)
    assert rows(found) == sorted(plainly(docs, items), key=str)


def test_groups_and_bounds():
    rng = np.random.default_rng(2)
    for width in (1, 3):
        found = rng.integers(0, 3, (200, width)).astype(np.uint64) << np.uint64(50)
        distinct, order, first = masks.groups(found)
        assert len({tuple(m) for m in found.tolist()}) == len(distinct) and first[-1] == 200
        for g, m in enumerate(distinct):
            assert (found[order[first[g]:first[g + 1]]] == m).all()
        most = rng.integers(1, 100, 64 * width)
        plain = [sum(int(most[i]) for i in range(64 * width) if int(m[i // 64]) >> i % 64 & 1) for m in distinct]
        assert masks.bounds_of(distinct, most).tolist() == plain


def test_masks_that_cannot_enter_are_not_scored():
    rng = np.random.default_rng(4)
    n, count = 5000, 30
    has = rng.random((n, count)) < np.linspace(0.005, 0.6, count)
    has[:, 0] |= ~has.any(axis=1)
    bounds = np.concatenate([[0], np.cumsum(has.sum(1))])
    terms = np.nonzero(has)[1]
    tf = rng.integers(1, 4, len(terms))
    sizes = rng.integers(50, 200, n)
    block = masks.Block(sizes, bounds, terms, tf, count, n, int(sizes.sum()))
    weights = np.array([masks.weight(n, int(d)) for d in has.sum(0)], np.int64)
    best = masks.Best(10)
    scored = masks.search(block, pa.array(np.arange(n)), np.arange(count), weights, best)
    every = block.scores(np.arange(n), weights)
    expected = sorted(((-s, d) for d, s in enumerate(every.tolist())))[:10]
    assert [(-s, d) for s, d in best.rows] == expected and scored < n / 10
    assert masks.search(block, pa.array(np.arange(n)), np.arange(count), weights // 10**6, best) == 0


def test_words_of_one_hash_are_told_apart():
    terms = masks.Terms([b"one", b"two", b"eno"])
    (names, numbers), = terms.tables
    one = names[numbers == 0]
    terms.tables = [(one, np.array([0])), (one, np.array([1])), (one, np.array([2]))]  # as if all three had one hash
    n, row, term, tf = terms.counts(pa.array(["One one two", None, "eno one"]))
    assert n.tolist() == [3, 0, 2] and list(zip(row.tolist(), term.tolist(), tf.tolist())) == [(0, 0, 2), (2, 0, 1)]
    assert masks.Terms([]).counts(pa.array(["x y"]))[0].tolist() == [2]


def test_odd_tables(spark, tricky):  # noqa: F811
    items = spark.createDataFrame([(1, "moon CAT"), (2, None), (3, "word"), (4, "é ü")], ITEMS)
    held = tricky.withColumnRenamed("lang", "n").withColumnRenamed("label", "terms").withColumnRenamed("score", "item")
    docs = [(r.doc_id, r.text) for r in tricky.collect()]
    assert rows(masks.best_documents(held, items)) == sorted(plainly(docs, [(r.item_id, r.text) for r in items.collect()]), key=str)
    assert masks.best_documents(held.limit(0), items).count() == 0 and masks.best_documents(held, items.limit(0)).count() == 0
    named = held.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text")
    texts = items.select(F.concat(F.lit("q"), "item_id").alias("item_id"), "text", F.lit(1).alias("rank"))
    expected = plainly([(None if d is None else f"d{d}", t) for d, t in docs], [(r.item_id, r.text) for r in texts.collect()])
    assert rows(masks.best_documents(named, texts)) == sorted(expected, key=str)
