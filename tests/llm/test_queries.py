"""Every registered query against its SQL, and against brute force where SQL can't express it."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL
from llm_samples import documents  # noqa: F401
from test_catalog import _plain

from frostline.llm import catalog, packing, quality
from frostline.llm.text import WORD_PATTERN

WORDS = re.compile(WORD_PATTERN)
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(catalog.CHECKS))
def test_equals_sql(name, spark, duck):
    frame = catalog.QUERIES[name](spark, SMALL)
    result = duck.execute(catalog.CHECKS[name])
    columns = [c[0] for c in result.description]
    order = sorted(columns)
    assert sorted(frame.columns) == order
    expected = sorted(tuple(_plain(row[columns.index(c)]) for c in order) for row in result.fetchall())
    assert sorted(tuple(_plain(row[c]) for c in order) for row in frame.collect()) == expected


def test_rendezvous_takes_rows_only_into_the_new_shard(spark):
    rows = catalog.QUERIES["op3_sharding"](spark, SMALL).collect()
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_passages_find_every_long_shared_run(spark, texts):
    found = catalog.QUERIES["op2_passages"](spark, SMALL).collect()
    covered = defaultdict(set)
    for r in found:
        covered[r.doc_id].update(range(r.start, r.end))
    split = {d: words(t) for d, t in texts.items()}
    holders = defaultdict(set)
    for d, w in split.items():
        for i in range(len(w) - 50):
            holders[tuple(w[i:i + 51])].add(d)
    for d, w in split.items():
        for i in range(0, len(w) - 50, 7):
            if len(holders[tuple(w[i:i + 51])]) > 1:
                assert len(covered[d] & set(range(i, i + 51))) >= 45
    for r in found:  # what is listed is alike, word by word, to the stated degree
        a, b = Counter(split[r.doc_id][r.start:r.end]), Counter(split[r.other_doc_id][r.other_start:r.other_end])
        assert sum((a & b).values()) >= r.matched >= 0.8 * (r.end - r.start)


def test_compression_separates_held_out_labels(spark):
    rows = catalog.QUERIES["op5_compression"](spark, SMALL.replace("0.001", "0.01"))
    labels = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/labels.parquet")
    held = rows.where("held_out").join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in held)
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_packing_is_an_exact_round_trip(spark, texts):
    pieces = catalog.QUERIES["op6_packing"](spark, SMALL).collect()
    direct = packing.Words(packing.word_tokenizer()).tokenizer
    parts, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        parts[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    assert set(parts) == set(texts)
    for d, text in texts.items():
        ids = np.array([*direct.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(parts[d], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
    sizes = [sum(p.length for p in s) for s in sequences.values()]
    assert sum(s < 4096 for s in sizes) <= 1


def test_near_duplicates_equal_brute_force(spark, texts):
    rows = catalog.QUERIES["op8_orderminhash"](spark, SMALL).collect()
    of = {r.doc_id: r.class_id for r in rows}
    runs = {}
    for d, t in texts.items():
        w = words(t)
        grams = Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 0))) or Counter([tuple(w)] if w else [])
        runs[d] = {(g, i) for g, n in grams.items() for i in range(n)}
    links = [(a, b) for a in runs for b in runs if a < b and runs[a] and runs[b]
             and len(runs[a] & runs[b]) >= 0.8 * len(runs[a] | runs[b])]
    root = {d: d for d in runs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert of == {d: find(d) for d in runs}
    sizes = Counter(of.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in rows)


def test_quality_equals_brute_force(spark, texts, documents):
    import xxhash

    rows = {r.doc_id: r for r in catalog.QUERIES["op9_quality"](spark, SMALL).collect()}
    trusted = {r.doc_id for r in quality.trusted_documents(spark, SMALL).collect()}
    split = {d: re.findall(quality.WORD, t or "") for d, t in texts.items()}

    def hashed(*parts, seed=42):
        for p in parts:
            data = p.encode() if isinstance(p, str) else p.to_bytes(8, "little")
            seed = xxhash.xxh64(data, seed=seed).intdigest()
        return seed

    def grams(w):
        names = [hashed(x) for x in w]
        pairs = [hashed(a, b) for a, b in zip(names, names[1:])]
        return [x & (quality.BUCKETS - 1) for x in names + pairs]

    each = {d: grams(w) for d, w in split.items()}
    raw, target = Counter(), Counter()
    for d, g in each.items():
        raw.update(g)
        target.update(g if d in trusted else [])
    scale = sum(target.values()) / sum(raw.values())
    ratio = {b: np.log((target[b] + quality.STEADY) / (n * scale + quality.STEADY)) for b, n in raw.items()}
    for d, t in texts.items():
        t, w, r = t or "", split[d], rows[d]
        windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        twice = Counter(windows)
        repeated = {j for i, x in enumerate(windows) if twice[x] > 1 for j in range(i, i + 3)}
        lines = [x for x in t.split("\n") if re.search(quality.WORD, x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated))
        failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
        mean = np.mean([ratio[b] for b in each[d]]) if each[d] else None
        assert r.base_failed == failed and r.kept == (not failed and mean >= quality.LEAST)
        assert r.log_ratio is None if mean is None else abs(r.log_ratio - mean) < 1e-9


def test_warc_archives_hold_the_payloads(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in catalog.QUERIES["op10_warc"](spark, SMALL).collect():
        data = (pages[r.page_id] or "").encode()
        assert r.payload_bytes == len(data)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_pipeline_keeps_columns_and_tokens(spark, documents):
    import corpus_pipeline

    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SMALL).checkpoint()
        assert docs.schema == documents.schema, name
        assert 0 < docs.count() <= before.count()
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in last} == set(ids)
    assert {r.sequence_id: 0 for r in last}
