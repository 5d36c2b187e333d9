"""Operators on small tables: odd input, hot groups, several blocks, and helpers against simple versions."""

import gzip
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from llm_samples import tricky  # noqa: F401
from pyspark.sql import functions as F

from frostline.llm import compression, decontaminate, licenses, orderminhash, packing, passages, quality, sharding, text, urls, warc
from frostline.llm.components import components

ITEMS = "item_id bigint, text string"


def same_rows(found, frame, *columns):
    """All input rows and columns are still there."""
    assert found.count() == frame.count()
    for c in columns:
        key = lambda r: str(r[0])
        assert sorted(found.select(c).collect(), key=key) == sorted(frame.select(c).collect(), key=key)


def test_words_are_hashed_alike_in_any_batch():
    rows = ["Hello, wörld hello", "", None, "x", "hello WORLD", "  ", "a" * 2_500_000 + " b", "b"]
    hashes, bounds = text.hashed_words(pa.array(rows))
    plain = [text.split_words((r or "").encode()) for r in rows]
    assert np.diff(bounds).tolist() == [len(w) for w in plain]
    names = {}
    for w, h in zip([w for ws in plain for w in ws], hashes.tolist()):
        assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)
    assert text.hashed_words(pa.array([], pa.string()))[1].tolist() == [0]
    sliced = text.hashed_words(pa.array(rows).slice(3, 2))
    assert sliced[0].tolist() == hashes[bounds[3]:bounds[5]].tolist()


def test_decontamination_in_one_and_many_blocks(spark, tricky):
    items = spark.createDataFrame(
        [(1, "SAT on the mat"), (2, "cat"), (3, None), (4, ""), (2, "cat"), (None, "moon all"),
         (5, "the cat sat on the mat and looked at the moon all day")], ITEMS)
    one = decontaminate.find_leaks(tricky, items)
    many = decontaminate.find_leaks(tricky, items, block_words=20)
    same_rows(one, tricky, "doc_id", "label", "n_words")
    key = lambda r: str(r)
    assert sorted(one.collect(), key=key) == sorted(many.collect(), key=key)
    by_id = {r.doc_id: r.leaks for r in one.collect()}
    assert by_id[8]["items"] == ["1", "2", "5"] and [(s["start"], s["end"]) for s in by_id[8]["spans"]] == [(0, 12)]
    assert by_id[2]["n_words"] == 0 and by_id[2]["items"] == [] and by_id[9]["n_words"] == 30_000
    nothing = decontaminate.find_leaks(tricky, items.limit(0)).select("leaks.items").distinct().collect()
    assert [r[0] for r in nothing] == [[]]
    assert decontaminate.find_leaks(tricky.limit(0), items).count() == 0


def test_wu_manber_equals_simple_search():
    rng = random.Random(1)
    for _ in range(200):
        size = rng.randint(1, 4)
        windows = {tuple(rng.choice([b"a", b"b", b"c"]) for _ in range(size)): {"x"} for _ in range(3)}
        line = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(30)]
        expected = [(i, tuple(line[i:i + size])) for i in range(len(line) - size + 1) if tuple(line[i:i + size]) in windows]
        assert list(decontaminate.Search(windows).find(line)) == expected


def test_long_texts_are_searched_in_pieces(monkeypatch):
    tables = decontaminate.searches([("1", b"alpha beta gamma delta")], 10)
    line = b"x y alpha beta gamma delta z " * 50
    whole = decontaminate.leaks(line, tables)
    monkeypatch.setattr(decontaminate, "_PIECE", 13)
    assert decontaminate.leaks(line, tables) == whole and len(whole[1]) == 50


def test_shards_follow_weights_and_keep_repeated_rows(spark, tricky, monkeypatch):
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    shares = {r.shard: r["count"] / 20_000 for r in sharding.assign(keys, ["k"], [1, 2, 0, 5]).groupBy("shard").count().collect()}
    assert 2 not in shares and all(abs(shares[i] - w / 8) < 0.02 for i, w in ((0, 1), (1, 2), (3, 5)))
    same_rows(sharding.assign(tricky, ["doc_id"], [1, 1]), tricky, "doc_id", "label")
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 50)
    monkeypatch.setattr(sharding, "COPIES", 7)
    hot = spark.range(900).select((F.col("id") % 100 * (F.col("id") % 3)).alias("k"), F.lit(0).alias("shard"))
    rows = sharding.number(hot, "shard", F.md5(sharding.key_text("k")), 900).collect()
    assert sorted(r.slot for r in rows) == list(range(900))
    assert sharding.number(hot.limit(0), "shard", F.md5(sharding.key_text("k")), 0).count() == 0


def test_licenses_found_with_edits(spark):
    notice = ("Permission is hereby granted, free of charge, to any person or company obtaining a copy of this software and"
              " associated documentation files")
    rows = [(1, notice), (2, "MIT License. mit-license"), (3, None), (4, ""), (1, notice), (5, "gnu general public"), (6, "cc\nBY the apache license")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("labels", F.lit("mine"))
    found = licenses.scan(docs)
    same_rows(found, docs, "doc_id", "labels")
    by_id = {r.doc_id: r.licenses for r in found.collect()}
    assert by_id[1].labels == "mit" and by_id[1].n_base == 0 and 0.6 <= by_id[1].score < 1
    assert (by_id[2].n_base, by_id[2].first_word, by_id[2].last_word, by_id[2].base_labels) == (2, 0, 2, "mit")
    assert by_id[3].n_words == 0 and by_id[3].labels == "" and by_id[5].n_base == 0
    assert by_id[6].base_labels == "apache,cc-by"
    assert licenses.scan(docs.limit(0)).count() == 0


def test_compression_without_labels(spark, tricky):
    labels = spark.createDataFrame([(1, 1), (8, None), (None, 1)], "doc_id bigint, quality int")
    model = compression.fit(tricky, labels)
    found = compression.score(tricky, model)
    same_rows(found, tricky, "doc_id", "label")
    assert {round(r.score, 3) for r in found.collect()} == {0.999}
    assert compression.fit(tricky, labels.limit(0)).offset == 0
    assert compression.score(tricky.limit(0), model).count() == 0


def test_packing_odd_texts(spark, tricky):
    pieces = packing.packed(tricky, packing.word_tokenizer(), window=64, shard_bytes=1 << 15).collect()
    ends = [p for p in pieces if p.start + p.length == p.doc_tokens]
    assert len(ends) == tricky.count()
    assert sum(p.length for p in pieces) == sum(p.doc_tokens for p in ends)
    assert all(len(p.ids) == 4 * p.length for p in pieces)
    assert packing.packed(tricky.limit(0), packing.word_tokenizer()).count() == 0


def test_remembered_words_equal_the_tokenizer():
    odd = ["straße ɐ ᾳ ǆ ªº ⅷ ŉ ﬁ", "é, ó. ×, ÷. ß, À. ÿ", "x×, a÷. b", "a. b, c.\nd.\n e, f.", "é, ó. ñ.\n x", "a). b", "_, x", "…, y. z", "², a, b", ", , a. b", "Hello, World's don't. A.B, x..,",
           "İstanbul H̱ Å \x1cq \x0b v", "<|endoftext|> x <|ENDOFTEXT|>", "x" * 5000, "K ΣΣ 한국", "3.14, 5, '., 's. it's, THE'RE", "", None]
    known = packing.Words(packing.word_tokenizer())
    for _ in range(2):
        for texts in (odd, odd[::-1]):
            found = known.ids(pa.array(texts, pa.string()))
            for t, ids in zip(texts, found):
                assert np.frombuffer(ids, known.dtype).tolist() == known.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_urls(spark):
    rows = [(1, "http://a.example.net/en/x?q#f"), (2, "https://EXAMPLE.net"), (3, None), (4, "no scheme"), (5, "http://net/"), (6, "http://x.org/fr/"),
            (7, "ftp://badnet/"), (8, "http://www.q.io/a/"), (9, "x://q.io/a"), (1, "http://a.example.net/en/x?q#f"), (10, "http://" + "a." * 4000 + "net/")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("rule", F.lit("old"))
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    found = urls.judge(pages, rules, urls.shared_urls(pages))
    same_rows(found, pages, "page_id", "url")
    by_id = {r.page_id: (r.rule, r.verdict) for r in found.collect()}
    assert by_id[1] == ("example.net/en/", "allow") and by_id[2] == (None, "allow") and by_id[3] == by_id[4] == (None, "allow")
    assert by_id[5] == by_id[10] == ("net/", "block") and by_id[6] == ("org/fr/", "allow") and by_id[7] == (None, "allow")
    assert by_id[8] == by_id[9] == (None, "block")
    nothing = urls.judge(pages, rules.limit(0), urls.shared_urls(pages).limit(0))
    assert {r.verdict for r in nothing.collect()} == {"allow"}


def test_filter_has_no_false_negatives(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    bits = urls.bloom_filter(keys, "key", 94)
    asked = spark.range(30_000).select("id", F.concat(F.lit("k"), "id").alias("key"))
    passed = {r.id for r in asked.where(urls.may_hold(bits, F.col("key"), 94)).collect()}
    assert set(range(3000)) <= passed and len(passed) < 3000 + 27_000 * 0.02


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "x bigint, y bigint"), "x", "y").collect()}
    linked = {x for link in links for x in link}
    assert {x: found.get(x, x) for x in linked} == {x: find(x) for x in linked}


def test_near_duplicates_of_odd_texts(spark, tricky):
    rows = orderminhash.classes(tricky).collect()
    assert len(rows) == tricky.count()
    of = {r.doc_id: (r.class_id, r.class_size) for r in rows}
    assert of[1] == of[8] == (1, 3) and of[2] == (2, 1) and of[9] == (9, 1)
    assert orderminhash.classes(tricky.limit(0)).count() == 0
    docs = tricky.select("doc_id", "text").withColumn("n_chars", F.lit(1))
    assert sorted(str(r.doc_id) for r in orderminhash.near_dedup_stage(spark, docs, SMALL).collect()) == sorted(
        str(x) for x in (1, 2, 3, 4, 5, 6, 7, 9, None))


def test_variants_meet_through_their_base(spark):
    """1,000 variants are near the base, but not near each other: one class."""
    rng = random.Random(9)
    base = [f"w{rng.randint(0, 9999)}" for _ in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 1001):
        variant = list(base)
        for j in range(5):
            variant[60 * j + rng.randint(5, 54)] = f"v{i}x{j}"
        rows.append((i, " ".join(variant)))
    found = orderminhash.classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert len(found) == 1001 and {(r.class_id, r.class_size) for r in found} == {(0, 1001)}


def test_texts_with_a_passage_in_common_do_not_meet(spark, monkeypatch):
    """400 texts share 100 words and have 20 of their own: no pair is similar, and few are compared."""
    rng, pairs = random.Random(2), []
    common = " ".join(f"c{rng.randint(0, 9999)}" for _ in range(100))
    rows = [(i, f"{common} {' '.join(f'o{i}x{j}' for j in range(20))}") for i in range(400)]
    verified = orderminhash.verified
    monkeypatch.setattr(orderminhash, "verified", lambda p, t: pairs.append(p.count()) or verified(p, t))
    found = orderminhash.classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    assert found.where("class_size > 1").count() == 0 and sum(pairs) <= 32 * 400


def test_groups_without_a_base_equal_all_pairs(spark):
    """Chains of edits: neighbours are similar, the ends are not. Classes are those of all pairs."""
    rng, rows = random.Random(12), []
    for g in range(6):
        words = [f"g{g}w{rng.randint(0, 9999)}" for _ in range(rng.choice([12, 60, 150]))]
        for _ in range(30):
            rows.append((len(rows), " ".join(words)))
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = f"n{rng.randint(0, 10**9)}"
    texts = [np.array([hash(w) for w in t.split()], np.int64).view(np.uint64) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if orderminhash.similar(texts[i], texts[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    found = orderminhash.classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    assert {r.doc_id: r.class_id for r in found.collect()} == {i: find(i) for i in range(len(rows))}


def test_near_dedup_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 1, 2, 3), (2, "a b c d e f", 4, 5, 6), (3, None, 7, 8, 9)],
                                 "doc_id bigint, text string, row int, key int, _k int").withColumn("class_id", F.lit(0)).withColumn("id", F.lit(1))
    found = orderminhash.near_dedup_stage(spark, docs, SMALL)
    assert found.columns == docs.columns and sorted(r.doc_id for r in found.collect()) == [1, 3]


def test_alignment_equals_simple_version():
    rng = random.Random(3)
    for _ in range(500):
        x, y = ([rng.randint(0, 3) for _ in range(rng.randint(0, 9))] for _ in range(2))
        best = [0] * (len(y) + 1)
        for a in x:
            row = [0]
            for j, b in enumerate(y):
                row.append(best[j] + 1 if a == b else max(best[j + 1], row[-1]))
            best = row
        edits = len(x) + len(y) - 2 * best[-1]
        for most in (0, 2, 5, 30):
            assert orderminhash.aligned(x, y, most) == (best[-1] if edits <= most else None)


def test_sketches_meet_at_the_limit():
    """Texts of similarity about 0.8 share a sketch; unlike texts hardly ever do."""
    rng = random.Random(8)
    met = 0
    for _ in range(100):
        a = [f"w{rng.randint(0, 9999)}" for _ in range(300)]
        b = list(a)
        for i in rng.sample(range(300), 7):
            b[i] = "new"
        hashes, bounds = text.hashed_words(pa.array([" ".join(a), " ".join(b)]))
        found = orderminhash.sketch(hashes, bounds)
        met += bool((found[0] == found[1]).any())
    assert met == 100


def test_chains_equal_simple_version():
    rng = random.Random(5)
    for _ in range(200):
        spots = sorted({(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(rng.randint(1, 25))})
        score = []
        for p, o in spots:
            score.append(1 + max([0, *(s - passages.SKIP * (p + o - q - r) for (q, r), s in zip(spots, score) if q < p and r < o)]))
        found = passages.chains(spots)
        value = lambda c: len(c) - passages.SKIP * (sum(c[-1]) - sum(c[0]))
        assert all(a[0] < b[0] and a[1] < b[1] for c in found for a, b in zip(c, c[1:]))
        assert max(score) <= 1 or abs(max(map(value, found)) - max(score)) < 1e-9


def test_passages_are_cut_once(spark, tricky):
    rng = random.Random(2)
    word = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    shared, own = word(60), [word(80) for _ in range(4)]
    fuzzy = shared.split()
    fuzzy[20], fuzzy[40] = "other", "words here"
    rows = [(1, f"{own[0]} {shared} end one"), (2, f"{own[1]} {shared}"), (3, f"{shared} {own[2]}"), (4, f"{own[3]} {' '.join(fuzzy)}"),
            (5, None), (6, ""), (7, f"{own[1]} {shared}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_chars", F.lit(0).cast("bigint"))
    kept = {r.doc_id: r.text for r in passages.substring_dedup_stage(spark, docs, SMALL).collect()}
    assert set(kept) == {1, 2, 3, 4, 5, 6}
    whole = sum(len(set(shared.split()) & set((t or "").split())) >= 50 for t in kept.values())
    assert whole == 1
    assert all(own[i - 1] in kept[i] for i in (1, 2, 3, 4))
    found = passages.shared(tricky)[0]
    assert found.count() == 0
    assert passages.substring_dedup_stage(spark, docs.limit(0), SMALL).count() == 0


@pytest.mark.parametrize("gap", [30, 60, 100, 150, 200])
def test_two_passages_apart_are_both_found(gap):
    rng = random.Random(gap)
    word = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    for _ in range(20):
        one, two = word(55), word(55)
        x, y = (text.hashed_words(pa.array([" ".join([*word(70), *one, *word(gap), *two, *word(70)])]))[0] for _ in range(2))
        sides = [text.shingles(h, np.array([0, len(h)]), passages.K) for h in (x, y)]
        (p, o) = ({int(r[i]): int(i) for i in passages.winnowed(r, e)} for r, e in sides)
        found = [f for c in passages.chains([(p[s], o[s]) for s in p if s in o]) for f in passages.parts(x, y, c)]
        covered = {i for a, b, *_ in found for i in range(a, b)}
        assert {*range(70, 125), *range(125 + gap, 180 + gap)} <= covered
        assert len(covered) <= 116


def test_frequent_lines_in_a_shared_order_are_found(spark):
    """Each line of a passage is owned by some text that has no other line of it."""
    rng = random.Random(6)
    word = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    rows, spans = [], {}
    for i in range(10):
        lines = [word(15) for _ in range(4)]
        rows += [(f"x{i}", f"{word(70)} {' '.join(lines)} {word(70)}"), (f"y{i}", f"{word(70)} {' '.join(lines)} {word(70)}")]
        rows += [(f"{i} {j} {k}", f"{word(30)} {line} {word(30)}") for j, line in enumerate(lines) for k in range(8)]
    found, held, _ = passages.shared(spark.createDataFrame(rows, "doc_id string, text string"))
    names = {r.a: r.doc_id for r in held.select("a", "doc_id").collect()}
    for r in found.collect():
        spans.setdefault(frozenset((names[r.a], names[r.owner])), set()).update(range(r.start, r.end))
    for i in range(10):
        assert spans.get(frozenset((f"x{i}", f"y{i}")), set()) >= set(range(70, 130))


def test_cover_holds_what_was_added():
    rng = random.Random(8)
    for _ in range(200):
        cover, covered = passages.Cover(), set()
        for _ in range(rng.randint(1, 12)):
            start = rng.randint(0, 60)
            end = start + rng.randint(1, 15)
            cover.add(start, end)
            covered |= set(range(start, end))
        assert {i for s, e in cover.spans for i in range(s, e)} == covered
        assert all(a[1] < b[0] for a, b in zip(cover.spans, cover.spans[1:]))
        for _ in range(20):
            start = rng.randint(0, 70)
            end = start + rng.randint(1, 9)
            assert cover.holds(start, end) == (set(range(start, end)) <= covered)


def test_a_repeated_line_has_few_rows(spark):
    line = " ".join(f"v{i}" for i in range(20))
    ends = [" ".join(f"{c}{i}" for i in range(30)) for c in "ab"]
    rows = [(i, f"{end} " + f"{line} " * 300 + end) for i, end in enumerate(ends)]
    found, held, _ = passages.shared(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = found.collect()
    other, own = ([r for r in found if (r["a"] == r["owner"]) == same] for same in (False, True))
    assert 0 < len(found) < 400
    covered = lambda rows: {i for r in rows for i in range(r["start"], r["end"])}
    assert covered(other) >= set(range(30, 6030 - 60)) and covered(own) >= set(range(30 + 40, 6030 - 60))
    assert all(r["owner_end"] <= r["start"] for r in own)


def test_owners_repeats_are_passages(spark):
    """A text with the passage twice lists both, and the stage keeps one occurrence, whichever text is the owner."""
    rng = random.Random(7)
    word = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    shared = {f"x{i}": word(60) for i in range(10)}
    rows = [(x, f"{word(70)} {s} {word(70)} {s} {s} {word(70)}", 0) for x, s in shared.items()]
    rows += [(f"y{x}", f"{word(70)} {s} {word(70)}", 0) for x, s in shared.items()]
    docs = spark.createDataFrame(rows, "doc_id string, text string, n_chars bigint")
    found, held, _ = passages.shared(docs)
    names, covered = {r.a: r.doc_id for r in held.select("a", "doc_id").collect()}, {}
    for r in found.collect():
        assert r.a != r.owner or r.owner_end <= r.start
        covered.setdefault(names[r.a], set()).update(range(r.start, r.end))
        covered.setdefault(names[r.owner], set()).update(range(r.owner_start, r.owner_end))
    assert all({*range(70, 130), *range(200, 320)} <= covered[x] and set(range(70, 130)) <= covered[f"y{x}"] for x in shared)
    kept = {r.doc_id: r.text for r in passages.substring_dedup_stage(spark, docs, SMALL).collect()}
    assert all(kept[x].count(s) + kept[f"y{x}"].count(s) == 1 for x, s in shared.items())


def test_quality_of_odd_texts(spark, tricky):
    none = spark.createDataFrame([], "doc_id bigint")
    found = quality.judge(tricky, none)
    same_rows(found, tricky, "doc_id", "label", "n_words")
    by_id = {r.doc_id: r.quality for r in found.collect()}
    assert by_id[2].n_words == 0 and by_id[2].log_ratio is None and not by_id[2].kept
    assert by_id[9].n_repeat_words == 30_000 and by_id[9].base_failed and by_id[6].n_words == 5
    assert quality.judge(tricky.limit(0), none).count() == 0


@pytest.mark.parametrize("segment", [1 << 20, 5])
def test_warc_round_trip(spark, tmp_path, segment):
    rows = [("r1", "http://a/ü x", "line one\r\nWARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n", None), ("r2", None, "", None), ("r3", "http://b", None, None),
            ("r4", "http://c", "é" * 40 + "\r", None), ("r5", "http://d", "same", "r6"), ("r6", "http://d", "same", None), ("r7", "x", "ends\r\n", None)]
    frame = spark.createDataFrame(rows, "id string, url string, body string, of string").coalesce(1)
    warc.write(frame, str(tmp_path / "w"), "id", "url", "body", "of", segment=segment)
    found = {r.record_id: r for r in warc.read(spark, str(tmp_path / "w")).collect()}
    chunks = {r.record_id: r for r in warc.chunk_table(frame, "id", "body", segment).where("last").collect()}
    for record, _, body, of in rows:
        r = found[record]
        assert (r.payload_bytes, r.payload_digest) == (len((body or "").encode()), chunks[record].digest)
        assert (r.record_type, r.refers_to) == (("revisit", of) if of else ("response", None))
    raw = gzip.decompress(next(Path(tmp_path / "w").glob("*.gz")).read_bytes())
    assert raw.startswith(b"WARC/1.1\r\n") and (segment > 5) == (b"WARC-Type: continuation" not in raw)
    warc.write(frame.limit(0), str(tmp_path / "none"), "id", "url", "body", "of")
    assert warc.read(spark, str(tmp_path / "none")).count() == 0


def test_revisits_name_the_largest_id(spark):
    pages = spark.createDataFrame([(1, "a"), (5, "a"), (3, "a"), (2, None), (4, ""), (6, "b")], "page_id bigint, html string")
    found = {r.page_id: r.refers_to for r in warc.revisits(pages, "page_id", "html").collect()}
    assert found == {1: 5, 3: 5, 5: None, 2: 4, 4: None, 6: None}
    assert all(r.refers_to is None for r in warc.revisits(pages, "page_id", "html", least=2).collect())


def test_quality_counts_every_trusted_document(spark):
    """With the whole corpus trusted, target and corpus have the same shares, however many documents there are."""
    docs = spark.range(150_000).selectExpr("id AS doc_id", "concat('w', id % 977, ' x', id % 31, ' y', id DIV 50000) AS text")
    ratios = docs.limit(1).select(quality.log_ratios(docs, docs.select("doc_id"), "doc_id", "text").alias("r")).first()["r"]
    assert len(ratios) == quality.BUCKETS and max(map(abs, ratios)) < 1e-12


def test_quality_marks_documents_alike_at_every_size(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, None)], "doc_id bigint, text string")
    trusted = spark.createDataFrame([(1,), (1,), (3,), (None,)], "doc_id bigint")
    found = quality.marked(docs, trusted, "doc_id", "text")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    rows = [(r["_text"], r["_trusted"]) for r in found.collect()]
    assert sorted(rows, key=str) == sorted([("a", 1), ("b", 1), ("c", None), ("d", None), (None, 1)], key=str)
