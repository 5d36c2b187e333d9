"""SentencePiece encoding that keeps, for every piece, the bytes of the original text it stands for, and decoding.

A text is normalised by the model's own compiled character map (a double-array trie of rules): at each place the longest
rule that begins there applies, elsewhere a character stands for itself. Beside each byte of the result stands the place
in the text it comes from. The model's white space rules (prefix, collapsing, the mark for a blank) follow. Pieces are
found in the normalised text, and each is projected back to a span of bytes through these places.

No piece of the model has a blank's mark behind another character, so a text falls apart before such marks: what lies
between is segmented by itself, once for a batch, and remembered. Models that do have such a piece are given whole texts.

A null text is empty; a byte that isn't UTF-8 counts as U+FFFD. An empty text has the end id alone. The spans of a text
rise, meet each other, begin at its first byte and end at its last (white space that the model removes at the ends
belongs to none). Of a character that is written as bytes, the last byte has the whole. Repeated rows are encoded as
often as they come. An empty table gives no row. Only the named columns are read; the id may be of any type. A text is
held whole by one task, with about fifty times its size beside it.
"""

import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from frostline.llm.text import flat_bytes, small_slices

MARK = "▁"
_MARK = np.frombuffer(MARK.encode(), np.uint8)
_PARTS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Parts of texts that a worker remembers, and ids of them.
REMEMBERED, REMEMBERED_IDS = 250_000, 2_000_000
#: Bytes of text that are encoded together.
SLICE = 1 << 20
#: Numbers of the model format: kind of model, kinds of pieces.
_BPE, _USER_DEFINED, _BYTE = 2, 4, 6


class CharacterMap:
    """A compiled map of character sequences to their replacements."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled[4:4 + size], "<u4").tolist()
        self.texts = compiled[4 + size:]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << (8 if unit & 0x200 else 0)

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest rule that begins here."""
        units, found = self.units, None
        if not units:
            return None
        node = self._offset(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units) or units[node] & 0x800000FF != text[i]:
                break
            unit = units[node]
            node ^= self._offset(unit)
            if unit & 0x100:  # a rule ends here; its replacement's place is where the next node begins
                found = units[node] & 0x7FFFFFFF, i + 1 - at
        if not found:
            return None
        place, length = found
        return self.texts[place:self.texts.index(b"\0", place)], length


def _sound(text: bytes) -> bool:
    try:
        text.decode()
    except UnicodeDecodeError:
        return False
    return True


class Normaliser:
    """Normalised bytes of texts, and for each (and the end) the place in the text it comes from."""

    def __init__(self, compiled: bytes, prefix: bool, collapse: bool, marks: bool, symbols: list[str]):
        self.rules = CharacterMap(compiled) if compiled else None
        self.prefix, self.collapse, self.marks = prefix, collapse, marks
        longest_first = sorted((s.encode() for s in symbols), key=len, reverse=True)
        self.symbols = re.compile(b"|".join(map(re.escape, longest_first))) if symbols else None
        self.blank = MARK.encode() if marks else b" "

    def _steps(self, text: bytes) -> Iterator[tuple[bytes, int, int]]:
        """What each prefix in turn becomes, and where it begins and ends."""
        at = 0
        while at < len(text):
            symbol = self.symbols.match(text, at) if self.symbols else None
            rule = None if symbol or self.rules is None else self.rules.longest(text, at)
            if rule:
                became, end = rule[0], at + rule[1]
            else:
                first = text[at]
                end = symbol.end() if symbol else at + (1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4)
                became = text[at:end]
                try:
                    became.decode()
                except UnicodeDecodeError:
                    became, end = b"\xef\xbf\xbd", at + 1
            yield became, at, end
            at = end

    def one(self, text: bytes) -> tuple[bytes, np.ndarray]:
        out, places, spaced, begun, end = bytearray(), [], self.collapse, False, 0
        for became, start, end in self._steps(text):
            kept = became.lstrip(b" ") if spaced else became
            if not begun and (kept or not self.collapse):
                begun = True
                if self.prefix:
                    out += self.blank
                    places += [start] * len(self.blank)
            if kept:
                shown = kept.replace(b" ", self.blank)
                out += shown
                places += [start] * len(shown)
                spaced = self.collapse and kept.endswith(b" ")
        while self.collapse and out.endswith(self.blank):
            end = places[-len(self.blank)]
            del out[-len(self.blank):], places[-len(self.blank):]
        return bytes(out), np.array([*places, end if out else 0], np.int64)

    def all(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For texts one after another: normalised bytes, each text's bounds among them, and the place of each byte
        counted over all texts, with each text's end behind its bytes (so a text has one place more than bytes).
        """
        raw = data.tobytes()
        if self.rules is None and self.symbols is None and not self.collapse and _sound(raw):
            return self._plain(data, bounds)
        each = [self.one(raw[a:b]) for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
        ends = np.cumsum([0, *(len(t) for t, _ in each)])
        places = [p + a for (_, p), a in zip(each, bounds.tolist())]
        return np.frombuffer(b"".join(t for t, _ in each), np.uint8), ends, np.concatenate(places or [np.zeros(0, np.int64)])

    def _plain(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Without rules: characters stand for themselves, only blanks and the prefix change."""
        filled = np.flatnonzero(np.diff(bounds) > 0)
        extra = len(self.blank) if self.prefix else 0
        width = np.ones(len(data), np.int64)
        if self.marks:
            width[data == 0x20] = len(_MARK)
        ahead = np.zeros(len(data) + 1, np.int64)
        ahead[bounds[filled]] = extra
        size = width + ahead[:-1]
        before = np.concatenate([[0], np.cumsum(size)])
        out = np.empty(before[-1], np.uint8)
        spot = before[:-1] + ahead[:-1]
        out[spot] = data
        blanks = spot[data == 0x20] if self.marks else np.zeros(0, np.int64)
        if extra:
            blanks = np.concatenate([before[bounds[filled]], blanks])
        for i, byte in enumerate(np.frombuffer(self.blank, np.uint8)):
            out[blanks + i] = byte
        begins = np.flatnonzero(data & 0xC0 != 0x80)
        start = np.zeros(len(data), np.int64)
        start[begins] = begins
        start = np.repeat(np.maximum.accumulate(start), size)
        ends = before[bounds]
        return out, ends, np.insert(start, ends[1:], bounds[1:])


class Numbers(dict):
    """Numbers of parts, in the order in which they are first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, part: str) -> int:
        self[part] = number = len(self)
        self.new.append(part)
        return number

    def taken(self) -> list[str]:
        """The parts that got their numbers since this was last asked."""
        new, self.new = self.new, []
        return new


class Pieces:
    """A model's pieces for texts, with their spans."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        if proto.trainer_spec.model_type != _BPE or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model must be of byte pairs, with blanks before words")
        spec = proto.normalizer_spec
        self.normaliser = Normaliser(
            spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces,
            [p.piece for p in proto.pieces if p.type == _USER_DEFINED])
        self.whole = SentencePieceProcessor(model_proto=model)
        # The same pieces without any normalisation: what is given to it is normalised already.
        spec.precompiled_charsmap = b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.inner = SentencePieceProcessor(model_proto=proto.SerializeToString())
        names = [p.piece for p in proto.pieces]
        self.length = np.array([1 if p.type == _BYTE else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.parted = MARK in names and not any(re.search(f"[^{MARK}]{MARK}", n) for n in names)
        self.end, self.unknown = self.whole.eos_id(), self.whole.unk_id()
        self._forget()

    def _forget(self) -> None:
        self.known = Numbers()
        self.ids, self.sizes, self.bounds = array("i"), array("i"), array("q", [0])

    def _learn(self, parts: list[str]) -> None:
        """Ids and lengths of the parts that were numbered last."""
        found = self.inner.encode(parts, num_threads=1)
        ids = np.fromiter(chain.from_iterable(found), np.int32)
        sizes = self.length[ids].astype(np.int32)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        if (ids == self.unknown).any():
            for i in np.unique(np.searchsorted(ends, np.flatnonzero(ids == self.unknown), "right")).tolist():
                shown = self.inner.encode(parts[i], out_type=str)
                sizes[ends[i] - len(shown):ends[i]] = [len(s.encode()) if n == self.unknown else self.length[n] for n, s in zip(found[i], shown)]
        self.bounds.frombytes((ends + len(self.ids)).tobytes())
        self.ids.frombytes(ids.tobytes())
        self.sizes.frombytes(sizes.tobytes())

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts one after another without the end id, each text's bounds among them, and starts and ends of
        their spans, in bytes of their text.
        """
        if len(self.known) > REMEMBERED or len(self.ids) > REMEMBERED_IDS:
            self._forget()
        data, bounds = flat_bytes(texts)
        normal, ends, places = self.normaliser.all(data, bounds)
        raw, parts, counts = normal.tobytes(), [], []
        for a, b in zip(ends.tolist(), ends[1:].tolist()):
            text = raw[a:b].decode()
            mine = _PARTS.findall(text) if self.parted else [text] * bool(text)
            parts += mine
            counts.append(len(mine))
        which = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
        self._learn(self.known.taken())
        first = np.frombuffer(self.bounds, np.int64)
        size = first[which + 1] - first[which]
        last = np.cumsum(size)
        spots = np.arange(last[-1] if len(last) else 0) - np.repeat(last - size - first[which], size)
        ids, length = (np.frombuffer(x, np.int32)[spots] if len(spots) else np.zeros(0, np.int32) for x in (self.ids, self.sizes))
        rows = np.concatenate([[0], last])[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
        # Where each piece ends among the normalised bytes; places have one number more for each text before.
        text = np.repeat(np.arange(len(counts)), np.diff(rows))
        stop = np.cumsum(length, dtype=np.int64)
        base = bounds[:-1][text]
        starts, stops = places[stop - length + text] - base, places[stop + text] - base
        return ids, rows, starts, stops


_models: dict[int, Pieces] = {}


def _pieces(model: bytes) -> Pieces:
    """The model, loaded once for each worker."""
    name = hash(model)
    if name not in _models:
        _models[name] = Pieces(model)
    return _models[name]


def encoded(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, ids, starts, ends) for every row: ids with the end id, and each one's bytes [start, end)."""
    content = docs.sparkSession.sparkContext.broadcast(model)  # the vocabulary: half a megabyte, whatever the input

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(content.value)
        for whole in batches:
            for batch in small_slices(whole, "text", SLICE):
                ids, rows, starts, ends = pieces.encode(batch.column("text"))
                n = np.diff(flat_bytes(batch.column("text"))[1])
                lists = [np.insert(column, rows[1:], last) for column, last in ((ids, pieces.end), (starts, n), (ends, n))]
                at = pa.array(rows + np.arange(len(rows)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), *(pa.ListArray.from_arrays(at, pa.array(c, pa.int32())) for c in lists)],
                    ["doc_id", "n_bytes", "ids", "starts", "ends"])

    held = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    numbers = ArrayType(IntegerType())
    schema = StructType([held.schema["doc_id"], StructField("n_bytes", LongType()), *(StructField(c, numbers) for c in ("ids", "starts", "ends"))])
    return held.mapInArrow(made, schema)


def decoded(rows: DataFrame, model: bytes, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Every row with the text of its ids in column `out`, which replaces one of that name. No ids, no text; null ids are passed over."""
    content = rows.sparkSession.sparkContext.broadcast(model)
    rows = rows.drop(out)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _pieces(content.value).whole.decode
        for batch in batches:
            texts = [decode(x.values.drop_null().to_numpy().tolist()) if x.is_valid else None for x in batch.column(ids)]  # one by one
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return rows.mapInArrow(made, StructType([*rows.schema.fields, StructField(out, StringType())]))


def piece_model() -> bytes:
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def op11_pieces(spark, sf_dir: str) -> DataFrame:
    """`n_bytes` are those of the text, `spanned` the last byte that a piece's span reaches: they agree."""
    docs, model = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), piece_model()
    found = encoded(docs, model).select("doc_id", "ids", "n_bytes", F.element_at("ends", -1).cast("bigint").alias("spanned"))
    return decoded(found, model).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "n_bytes", "spanned")
