"""WARC archives by chunks: records are written and read as rows of one chunk each, with running SHA-1 digests.

No step holds a second copy of a payload. Written records above `segment` bytes are cut into WARC segments (a response
and its continuations), each a row of its own. The reader walks an archive line by line and carries the digest of the
record that it is in from one Arrow batch to the next.

Spark's text reader and writer do all input and output, so any store that Spark reaches will do. Archives are whole
gzip files, which Spark never splits: one task reads one file from its start.

A null payload is empty. Null or blank URLs write no target; control characters and spaces in them are percent-coded.
A null record id is written and read as the empty id. Repeated rows are written as often as they come. Empty tables
give an archive without records. Only the named columns are read, so other columns can't clash.
"""

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from frostline.workspace import fresh_path

#: Bytes of a payload in one row.
SEGMENT = 1 << 20
_END = b"\r\n"
#: Rows of an Arrow batch going out.
_ROWS, _BYTES = 512, 8 << 20
RECORDS = "record_id string, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to string"
CHUNKS = "record_id string, chunk int, last boolean, data binary, payload_bytes bigint, digest string"


def base32_sha1(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


def cut(payload: memoryview, size: int) -> Iterator[memoryview]:
    """Parts of at most `size` bytes that end between UTF-8 characters; an empty payload is one empty part."""
    at = 0
    while True:
        end = min(at + size, len(payload))
        while at < end < len(payload) and payload[end] & 0xC0 == 0x80 and end > at + 1:
            end -= 1
        yield payload[at:end]
        at = end
        if at >= len(payload):
            return


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (bytes, str, memoryview)))
        if len(held) >= _ROWS or size >= _BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _payloads(batch: pa.RecordBatch, name: str) -> Iterator[memoryview]:
    for value in batch.column(name).cast(pa.large_binary()):
        yield memoryview(value.as_buffer()) if value.is_valid else memoryview(b"")


def chunk_table(rows: DataFrame, record_id: str, payload: str, segment: int = SEGMENT) -> DataFrame:
    """One row for each record and chunk: number, bytes, bytes so far, and the SHA-1 (base 32) of the payload so far."""
    schema = pa.schema([("record_id", pa.string()), ("chunk", pa.int32()), ("last", pa.bool_()), ("data", pa.binary()),
                        ("payload_bytes", pa.int64()), ("digest", pa.string())])

    def chunks(batches):
        for batch in batches:
            for record, data in zip(batch.column("r").to_pylist(), _payloads(batch, "p"), strict=True):
                running, done = hashlib.sha1(), 0
                for i, part in enumerate(cut(data, segment)):
                    running.update(part)
                    done += len(part)
                    yield record, i, done == len(data), bytes(part), done, base32_sha1(running)

    named = rows.select(F.col(record_id).cast("string").alias("r"), F.col(payload).alias("p"))
    return named.mapInArrow(lambda batches: _batches(chunks(batches), schema), CHUNKS)


def _head(kind: str, record: str, length: int, **fields: str | None) -> str:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record}>", f"Content-Length: {length}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in fields.items() if v]
    return "\r\n".join(lines) + "\r\n\r\n"


def _records(record: str, url: str, payload: memoryview, refers_to: str | None, date: str, segment: int) -> Iterator[str]:
    """The text of one record's segments, each without its last line end."""
    running = hashlib.sha1()
    for part in cut(payload, segment):
        running.update(part)
    digest = f"sha1:{base32_sha1(running)}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    about = {"WARC_Target_URI": quote(url or "", safe="!#$%&'()*+,/:;=?@[]~") if url else None, "WARC_Date": date,
             "Content_Type": "application/http; msgtype=response", "WARC_Payload_Digest": digest}
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield _head("revisit", record, len(http), WARC_Refers_To=f"<{refers_to}>", WARC_Profile=profile, **about) + http + "\r\n"
        return
    for i, part in enumerate(cut(payload, segment), 1):
        text, more = str(part, "utf-8", "surrogateescape"), len(payload) > segment
        if i == 1:
            number = {"WARC_Segment_Number": "1"} if more else {}
            yield _head("response", record, len(http) + len(part), **about, **number) + http + text + "\r\n"
        else:
            yield _head("continuation", f"{record}/{i}", len(part), WARC_Segment_Origin_ID=f"<{record}>",
                        WARC_Segment_Number=str(i), WARC_Date=date) + text + "\r\n"


def write(rows: DataFrame, path: str, record_id: str, url: str, payload: str, refers_to: str,
          date: str = "2024-01-01T00:00:00Z", segment: int = SEGMENT) -> None:
    """Archives below `path`. A row with `refers_to` becomes a revisit record without its payload."""
    schema = pa.schema([("value", pa.string())])

    def records(batches):
        for batch in batches:
            plain = zip(*(batch.column(c).to_pylist() for c in "rut"), _payloads(batch, "p"), strict=True)
            for record, target, other, data in plain:
                for text in _records(record, target, data, other, date, segment):
                    yield (text,)

    named = rows.select(F.coalesce(F.col(record_id).cast("string"), F.lit("")).alias("r"), F.col(url).alias("u"),
                        F.col(refers_to).cast("string").alias("t"), F.col(payload).alias("p"))
    texts = named.mapInArrow(lambda batches: _batches(records(batches), schema), "value string")
    texts.write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


class Reader:
    """Records of one archive, fed line by line (without the line's CR LF)."""

    def __init__(self):
        self.head: dict[str, str] = {}
        self.left = 0            # bytes of the block still to come
        self.http = b""          # head of an HTTP message as far as it has come; None past it
        self.running = hashlib.sha1()
        self.size = 0
        self.open: dict[str, str] | None = None  # the record whose segments are being read

    def feed(self, line: bytes) -> Iterator[tuple]:
        if self.left:
            yield from self._block(line + _END)
        elif line:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            if value:
                self.head[name.strip().lower()] = value.strip()
            else:
                self.head = {}   # the version line
        elif "content-length" in self.head:
            yield from self._begin()

    def _begin(self) -> Iterator[tuple]:
        kind = self.head.get("warc-type")
        if kind != "continuation":
            yield from self.end()
            self.running, self.size = hashlib.sha1(), 0
            self.open = self.head if kind in ("response", "revisit", "resource") else None
            self.http = b"" if "application/http" in self.head.get("content-type", "") else None
        self.left = int(self.head["content-length"])
        self.head = {}

    def _block(self, data: bytes) -> Iterator[tuple]:
        part = data[:self.left]
        self.left -= len(part)
        if self.http is not None:
            self.http += part
            head, blank, part = self.http.partition(b"\r\n\r\n")
            if not blank:
                return
            lengths = [x.partition(b":")[2] for x in head.split(_END) if x.lower().startswith(b"content-length:")]
            if self.open and lengths:
                self.open["http-length"] = lengths[0].decode().strip()
            self.http = None
        self.running.update(part)
        self.size += len(part)
        return
        yield

    def end(self) -> Iterator[tuple]:
        """The record whose segments have all come."""
        if self.open:
            at, other = self.open, self.open.get("warc-refers-to")
            revisit = at["warc-type"] == "revisit"
            digest = at.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else base32_sha1(self.running)
            size = int(at.get("http-length", 0)) if revisit else self.size
            yield at["warc-record-id"].strip("<>"), at.get("warc-target-uri"), at["warc-type"], size, digest, other.strip("<>") if other else None
        self.open = None


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the archives, digests computed from the bytes; a revisit's digest is the stated one."""
    fields = [("record_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
              ("payload_digest", pa.string()), ("refers_to", pa.string())]

    def records(batches):
        reader, file = Reader(), None
        for batch in batches:
            for line, name in zip(batch.column("line"), batch.column("file").to_pylist(), strict=True):
                if name != file:
                    yield from reader.end()
                    reader, file = Reader(), name
                yield from reader.feed(line.as_py())
        yield from reader.end()

    lines = spark.read.schema("value string").option("lineSep", "\r\n").text(path)
    lines = lines.select(F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"))
    return lines.mapInArrow(lambda batches: _batches(records(batches), pa.schema(fields)), RECORDS)


def revisits(rows: DataFrame, record_id: str, payload: str, least: int = 0, out: str = "refers_to") -> DataFrame:
    """`rows` with the largest id among equal payloads of at least `least` bytes, or null where that is the row's own.

    Rows that repeat an id with its payload are all responses. Equal payloads agree in length, SHA-1 and a 64-bit hash.
    """
    held = F.coalesce(F.col(payload), F.lit(""))
    key = F.struct(F.octet_length(held).alias("n"), F.sha1(held).alias("s"), F.xxhash64(held).alias("x"))
    shared = rows.select(key.alias("_key"), F.col(record_id).alias("_id")).where(F.col("_key.n") >= least)
    shared = shared.groupBy("_key").agg(F.max("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    found = rows.withColumn("_key", key).join(shared, "_key", "left").drop("_key")
    return found.withColumn(out, F.when(~F.col("_first").eqNullSafe(F.col(record_id)), F.col("_first"))).drop("_first")


def op10_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    rows = revisits(pages, "page_id", "html")
    named = rows.select(F.concat(F.lit("urn:page:"), "page_id").alias("record_id"), "url", "html",
                        F.concat(F.lit("urn:page:"), "refers_to").alias("refers_to"))
    path = fresh_path(spark, "warc")
    write(named, path, "record_id", "url", "html", "refers_to")
    page = lambda c: F.regexp_extract(c, "urn:page:(.*)", 1).try_cast("bigint")
    return read(spark, path).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


_BITS = "('0x' || substr(s, {at}, 5))::BIGINT"
_DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((({_BITS.format(at=5 * i + 1)}) >> {shift}) & 31)::INT + 1, 1)"
    for i in range(8) for shift in (15, 10, 5, 0))
SQL = f"""
WITH held AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
firsts AS (SELECT h, max(page_id) AS first FROM held GROUP BY h)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, {_DIGITS} AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM held JOIN firsts USING (h)
"""
