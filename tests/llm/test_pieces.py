"""Encoding with spans: against the library, on whole texts and odd ones, and the compiled character map."""

import hashlib
import random

import pyarrow as pa
import pytest
from conftest import SMALL
from llm_samples import documents, tricky  # noqa: F401
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from frostline.llm import catalog, pieces

ODD = ["", " ", "  ", " a", "a ", "a  b\t\n c", "▁", "▁▁x", "a▁b", "é é ﬁ Å", "日本語 テキスト", "\U0001F600\U0001F9FF⿿ x", "x" * 5000,
       "</s> <unk> <0x41>", "\x00a\r\n", "﻿​", " " * 40 + "end", "no.blank,here;at-all" * 50]


def compiled(rules):
    """A double-array trie of the rules as models hold it, with 256 units for each node."""
    texts, places = b"", {}
    for key, became in rules.items():
        places[key.encode()] = len(texts)
        texts += became.encode() + b"\0"
    units = [0] * 512

    def grow(node, prefix, base):
        labels = sorted({k[len(prefix)] for k in places if k.startswith(prefix) and len(k) > len(prefix)})
        leaf = prefix in places
        units[node] |= (base ^ node) << 10 | leaf << 8
        if leaf:
            units[base] = places[prefix] | 1 << 31
        for label in labels:
            units[base + label] = label
            below = len(units)
            units.extend([0] * 256)
            grow(base + label, prefix + bytes([label]), below)

    grow(0, b"", 256)
    trie = b"".join(u.to_bytes(4, "little") for u in units)
    return len(trie).to_bytes(4, "little") + trie + texts


RULES = {"ﬁ": "fi", "é": "é", "\t": " ", "\n": " ", "Å": "Å", "aa": "b", "aaa": "c", "​": "", "№": "No "}


def changed(**spec):
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(pieces.piece_model())
    for name, value in spec.items():
        setattr(proto.normalizer_spec, name, value)
    return proto.SerializeToString()


def test_longest_rule_wins():
    rules = pieces.CharacterMap(compiled(RULES))
    text = "aaaa ﬁée​".encode()
    assert rules.longest(text, 0) == (b"c", 3) and rules.longest(text, 1) == (b"c", 3) and rules.longest(text, 2) == (b"b", 2)
    assert rules.longest(text, 3) is None and rules.longest(text, 5) == (b"fi", 3)
    assert rules.longest("é".encode(), 0) == ("é".encode(), 3) and rules.longest(b"e", 0) is None
    assert rules.longest("​".encode(), 0) == (b"", 3)


def spans(found, row, text):
    ids, rows, starts, ends = found
    mine = slice(rows[row], rows[row + 1])
    return [(i, text[a:b]) for i, a, b in zip(ids[mine].tolist(), starts[mine].tolist(), ends[mine].tolist())]


@pytest.mark.parametrize("spec", [
    {}, {"remove_extra_whitespaces": True}, {"add_dummy_prefix": False}, {"precompiled_charsmap": compiled(RULES)},
    {"precompiled_charsmap": compiled(RULES), "remove_extra_whitespaces": True}])
def test_equals_library_for_other_normalisers(spec):
    model = changed(**spec)
    library, mine = SentencePieceProcessor(model_proto=model), pieces.Pieces(model)
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choices(["a", "aa", " ", "  ", "é", "№", "\t", "▁", "word", "​", "ﬁ", "日"], k=rng.randint(0, 30))) for _ in range(200)]
    found = mine.encode(pa.array(texts))
    for row, text in enumerate(texts):
        raw = text.encode()
        ids, starts, ends = (x[found[1][row]:found[1][row + 1]].tolist() for x in (found[0], *found[2:]))
        assert ids == library.encode(text), text
        assert all(a <= b for a, b in zip(starts, ends)) and ends[:-1] == starts[1:]
        if ids and not spec.get("remove_extra_whitespaces"):
            assert starts[0] == 0 and ends[-1] == len(raw)


def test_spans_are_the_source_of_the_pieces():
    mine = pieces.Pieces(changed(precompiled_charsmap=compiled(RULES)))
    text = "ﬁne\tcafé ⿿".encode()
    found = spans(mine.encode(pa.array([text.decode()])), 0, text)
    shown = [(mine.whole.id_to_piece(i), s.decode()) for i, s in found]
    assert "".join(s for _, s in shown) == text.decode()
    assert shown[-3:] == [("<0xE2>", ""), ("<0xBF>", ""), ("<0xBF>", "⿿")]
    assert "".join(p for p, _ in shown[:-3]) == "▁fine▁café▁"


def test_broken_bytes_count_as_replacement_characters():
    mine = pieces.Pieces(pieces.piece_model())
    found = mine.encode(pa.array([b"a\xffb", b"ok"], pa.binary()))
    assert found[0][found[1][0]:found[1][1]].tolist() == mine.whole.encode("a�b")
    assert found[2][0] == 0 and found[3][found[1][1] - 1] == 3


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    mine = pieces.Pieces(pieces.piece_model())
    for text in ["one two three four five", "five six", "one two"] * 2:
        assert mine.encode(pa.array([text]))[0].tolist() == mine.whole.encode(text)


def test_whole_table_equals_library(spark, documents):  # noqa: F811
    library = SentencePieceProcessor(model_proto=pieces.piece_model())
    rows = {r.doc_id: r for r in catalog.QUERIES["op11_pieces"](spark, SMALL).collect()}
    texts = documents.select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        ids = library.encode(text or "", add_eos=True)
        row = rows[doc_id]
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert row.n_bytes == row.spanned == len((text or "").encode())


def test_odd_rows_and_names(spark, tricky):  # noqa: F811
    library = SentencePieceProcessor(model_proto=pieces.piece_model())
    held = tricky.withColumnRenamed("lang", "ids").withColumnRenamed("label", "decoded")
    found = pieces.encoded(held, pieces.piece_model())
    rows = pieces.decoded(found, pieces.piece_model()).collect()
    key = lambda r: (r[0] is None, r[0], r[1])
    expected = sorted([(r.doc_id, library.encode(r.text or "", add_eos=True)) for r in tricky.collect()], key=key)
    assert sorted([(r.doc_id, r.ids) for r in rows], key=key) == expected
    for r in rows:
        assert r.ends[-1] == r.n_bytes and r.starts[0] == 0 and len(r.ids) == len(r.starts) == len(r.ends)
        assert r.decoded == library.decode(r.ids)
    named = spark.createDataFrame([("a", "x y"), ("b", None)], "doc_id string, text string")
    assert sorted((r.doc_id, r.ids) for r in pieces.encoded(named, pieces.piece_model()).collect()) == [
        ("a", library.encode("x y", add_eos=True)), ("b", [2])]
    assert pieces.encoded(held.limit(0), pieces.piece_model()).count() == 0
    nothing = spark.createDataFrame([(1, None, "old")], "n int, ids array<int>, decoded string")
    assert pieces.decoded(nothing, pieces.piece_model()).collect() == [(1, None, None)]
