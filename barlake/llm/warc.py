"""WARC archives: a writer of per-record gzip members with revisit records, and
a salvage reader that survives damaged bytes.

The reader lets Spark split files at member magics (or, for uncompressed
archives, at version lines), so it streams: a task holds one record at a time
and works in any store that Spark reads. A part between two delimiters is a
candidate record. If it is incomplete the delimiter stood inside the record and
the next part is appended; if it fails a check (inflation and CRC, header
syntax, Content-Length, payload digest) it is quarantined and the search goes on
at the next delimiter. A record cut by the border of two file splits is put
together in a second step from the open end of one and the unmatched start of
the other. Gaps are logged with their file, offset and length.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .staging import staged

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
#: Bytes of a record (inflated) beyond which a candidate counts as damaged.
MAX_RECORD = 1 << 30
MAX_HEADER = 1 << 16
#: Version line, then "name: value" lines without control bytes.
_HEADER = re.compile(rb"WARC/1\.\d+(\r\n[!-9;-~]+:[^\x00-\x08\x0a-\x1f\x7f]*)*")
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(data: bytes) -> bytes:
    """A gzip member whose last byte is 0: the writer ends rows with that byte.
    It is the top byte of the length, so 0 below 16 MiB; an empty member, which
    readers skip, follows a larger one."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = pack.compress(data) + pack.flush()
    return out if out[-1] == 0 else out + member(b"")


def record(page_id: str, uri: bytes | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC record. The HTTP head keeps the payload's length, also in a
    revisit record, which has no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if refers_to is not None else b"response"),
            b"WARC-Record-ID: <urn:page:%s>" % page_id.encode(), b"WARC-Date: " + date.encode()]
    if uri is not None:
        head.append(b"WARC-Target-URI: " + re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], uri))
    if refers_to is not None:
        head += [b"WARC-Refers-To: <urn:page:%s>" % refers_to.encode(), b"WARC-Profile: " + REVISIT_PROFILE]
    head += [b"WARC-Payload-Digest: sha1:" + digest.encode(), b"WARC-Block-Digest: sha1:" + base32_sha1(block).encode(),
             b"Content-Type: application/http;msgtype=response",
             b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
                  min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record for every row to files below ``path`` (one a task, through
    Spark's text sink, hence with its commit protocol and in any store).

    Of rows with equal payloads of at least ``min_bytes`` bytes, those with the
    smallest id are response records and the others revisit it. Defined cases: a
    null payload is empty; a null id is written as an empty one, refers to the
    group's smallest id if there is one, and is never referred to; a null URI
    has no header line; repeated rows give repeated records."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("id"), F.col(uri_col).cast("string").cast("binary").alias("uri"),
                        F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    again = rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha1").agg(
        F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").drop("n")
    again = staged(again, "repeated")  # its size is then known: broadcast if small, else a join that splits hot keys
    rows = rows.join(again, "sha1", "left")
    refers = F.when(F.col("id").isNull() | (F.col("id") > F.col("first")), F.col("first"))
    rows = rows.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "uri", "payload",
                       refers.cast("string").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, uri, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                out.append(member(record(key, uri, payload, base32_sha1(payload), refers_to, date))[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    members = rows.mapInArrow(run, "member binary").select(F.col("member").cast("string").alias("value"))
    members.write.option("lineSep", "\x00").text(path)


class Gzip:
    """A candidate gzip member."""

    def __init__(self) -> None:
        self.inflate, self.out, self.size = zlib.decompressobj(31), [], 0

    def feed(self, data: bytes) -> int | None:
        """None: more is needed; else the bytes of ``data`` after the record's
        end. Raises ValueError for a damaged record."""
        try:
            self.out.append(self.inflate.decompress(data))
        except zlib.error as e:
            raise ValueError("gzip") from e
        self.size += len(self.out[-1])
        if self.size > MAX_RECORD:
            raise ValueError("size")
        return len(self.inflate.unused_data) if self.inflate.eof else None

    def content(self) -> bytes:
        return b"".join(self.out)


class Plain:
    """A candidate record of an uncompressed archive."""

    def __init__(self) -> None:
        self.data, self.need = bytearray(), None

    def feed(self, data: bytes) -> int | None:
        self.data += data
        if self.need is None:
            end = self.data.find(b"\r\n\r\n", 0, MAX_HEADER)
            if end < 0:
                if len(self.data) >= MAX_HEADER:
                    raise ValueError("header")
                return None
            length = _fields(bytes(self.data[:end])).get(b"content-length", b"")
            if not length.isdigit() or int(length) > MAX_RECORD:
                raise ValueError("header")
            self.need = end + 4 + int(length) + 4
        return len(self.data) - self.need if len(self.data) >= self.need else None

    def content(self) -> bytes:
        return bytes(self.data[:self.need])


def _fields(head: bytes) -> dict[bytes, bytes]:
    pairs = [line.partition(b":") for line in head.split(b"\r\n")[1:]]
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


class Record(NamedTuple):
    record_id: str
    record_type: str
    refers_to: str | None
    uri: str | None
    payload_bytes: int
    payload_digest: str | None
    payload: bytes | None


def _name(field: bytes | None) -> str | None:
    return None if field is None else field.decode("utf-8", "replace").removeprefix("<urn:page:").removesuffix(">")


def parse(data: bytes) -> Record:
    """A record's parts; ValueError names the check that fails."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(VERSION) or end < 0 or not _HEADER.fullmatch(data[:end]):
        raise ValueError("header")
    fields = _fields(data[:end])
    length, block = fields.get(b"content-length", b""), data[end + 4:-4]
    if not length.isdigit() or int(length) != len(block) or data[-4:] != b"\r\n\r\n":
        raise ValueError("length")
    if fields.get(b"warc-type") is None or fields.get(b"warc-record-id") is None:
        raise ValueError("header")
    stated = fields.get(b"warc-block-digest", b"")
    if stated.startswith(b"sha1:") and stated[5:].decode("latin-1") != base32_sha1(block):
        raise ValueError("digest")
    kind, payload = fields[b"warc-type"].decode("utf-8", "replace"), block
    size = len(block)
    if fields.get(b"content-type", b"").startswith(b"application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        stated = _fields(http).get(b"content-length", b"")
        size = int(stated) if stated.isdigit() else len(payload)
    digest = fields.get(b"warc-payload-digest")
    digest = None if digest is None else digest.decode("utf-8", "replace").removeprefix("sha1:")
    if kind == "revisit":
        payload = None
    elif size != len(payload) or digest is not None and digest != base32_sha1(payload):
        raise ValueError("digest")
    uri = fields.get(b"warc-target-uri")
    return Record(_name(fields[b"warc-record-id"]), kind, _name(fields.get(b"warc-refers-to")),
                  None if uri is None else uri.decode("utf-8", "replace"), size, digest, payload)


class Search:
    """Recovers the records of consecutive parts. ``found`` gets (offset, length,
    reason or None, Record or None): a record, or a gap and its reason."""

    def __init__(self, delimiter: bytes, candidate: type):
        self.delimiter, self.candidate = delimiter, candidate
        self.open: list[tuple[int, bytes]] = []  # parts of the candidate, with offsets
        self.trial = None
        self.found: list[tuple[int, int, str | None, Record | None]] = []

    def put(self, offset: int, part: bytes) -> None:
        """``part`` with its delimiter at ``offset``."""
        waiting = [(offset, part)]
        while waiting:
            at, data = waiting.pop(0)
            self.open.append((at, data))
            if self.trial is None:
                self.trial = self.candidate()
            try:
                left = self.trial.feed(data)
                if left is None:
                    continue
                content = self.trial.content()
                start, stop = self.open[0][0], at + len(data) - left
                if content:  # an empty member is padding
                    self.found.append((start, stop - start, None, parse(content)))
                if left:
                    self.found.append((stop, left, "trailing", None))
                self.open, self.trial = [], None
            except ValueError as e:
                waiting = self._give_up(str(e)) + waiting

    def _give_up(self, reason: str) -> list[tuple[int, bytes]]:
        """The candidate's first part is a gap; the rest is searched again."""
        (at, data), *rest = self.open
        self.found.append((at, len(data), reason, None))
        self.open, self.trial = [], None
        return rest

    def end(self) -> None:
        """No part follows: what is still open is damaged."""
        while self.open:
            for at, data in self._give_up("truncated"):
                self.put(at, data)


_COLUMNS = ["file", "block", "kind", "offset", "length", "reason", *Record._fields, "part"]
_SCHEMA = ("file string, block long, kind string, offset long, length long, reason string, record_id string, "
           "record_type string, refers_to string, uri string, payload_bytes long, payload_digest string, "
           "payload binary, part binary")
_TYPES = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(),
          pa.string(), pa.int64(), pa.string(), pa.binary(), pa.binary()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(_COLUMNS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_COLUMNS)


def _rows(found: list, file: str, block: int, payloads: bool) -> list[tuple]:
    out = []
    for offset, length, reason, rec in found:
        values = tuple(rec) if rec else (None,) * len(Record._fields)
        out.append((file, block, "record" if rec else "gap", offset, length, reason,
                    *(values if payloads else (*values[:-1], None)), None))
    return out


def salvage(spark: SparkSession, path: str, compressed: bool = True, payloads: bool = True) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of the archives below ``path``.

    records: (file, offset, length, record_id, record_type, refers_to, uri,
    payload_bytes, payload_digest, payload); payload is null for revisits, and
    everywhere unless ``payloads``. gaps: (file, offset, length, reason), with
    reason gzip, size, header, length, digest, truncated, trailing or leading. The
    records, gaps and empty members of a file cover its bytes exactly.

    Compressed files must not have an extension that Spark decompresses itself.
    An empty file has neither records nor gaps."""
    delimiter, candidate = (MAGIC, Gzip) if compressed else (VERSION, Plain)
    parts = spark.read.option("lineSep", delimiter.decode("latin-1")).option("encoding", "ISO-8859-1").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("part"))
    size = len(delimiter)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, search, at, lead = None, None, 0, None

        def kept(rows: list[tuple[int, bytes]]) -> list[tuple]:
            return [(*key, "part", o, len(d), None, *[None] * len(Record._fields), d) for o, d in rows]

        def leave() -> list[tuple]:
            if key is None:
                return []
            span = (*key, "span", 0, at, None, *[None] * len(Record._fields), None)
            return [*kept(search.open if lead is None else lead), span]

        for batch in batches:
            out = []
            for file, block, part in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, block) != key:
                    out += leave()
                    key, search, at = (file, block), Search(delimiter, candidate), 0
                    # a later split begins with what may end a record of the one before
                    lead = [] if block else None
                    if not block:  # what stands before the first delimiter
                        if part:
                            out += _rows([(0, len(part), "leading", None)], *key, payloads)
                        at = len(part)
                        continue
                data = delimiter + part
                if lead is not None:
                    lead.append((at, data))
                search.put(at, data)
                at += len(data)
                if lead is not None:
                    good = next((offset for offset, *_, rec in search.found if rec), None)
                    if good is None:
                        search.found = []
                        continue
                    out += kept([x for x in lead if x[0] < good])
                    search.found = [x for x in search.found if x[0] >= good]
                    lead = None
                out += _rows(search.found, *key, payloads)
                search.found = []
            yield _batch(out)
        yield _batch(leave())

    seen = staged(parts.mapInArrow(first, _SCHEMA), "salvaged")
    before = Window.partitionBy("file").orderBy("block")
    base = seen.where("kind = 'span'").select("file", "block", (F.sum("length").over(before) - F.col("length")).alias("base"))
    placed = seen.where("kind <> 'span'").join(base, ["file", "block"]).withColumn(
        "offset", F.col("offset") + F.col("base")).select(*_COLUMNS)
    borders = placed.where("kind = 'part'").repartition("file").sortWithinPartitions("file", "offset")

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, search, at = None, Search(delimiter, candidate), None

        def drained() -> list[tuple]:
            out, search.found = _rows(search.found, file, 0, payloads), []
            return out

        for batch in batches:
            out = []
            for name, offset, data in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "part"))):
                if (name, offset) != (file, at):
                    search.end()
                    out += drained()
                file, at = name, offset + len(data)
                search.put(offset, data)
                out += drained()
            yield _batch(out)
        search.end()
        yield _batch(drained())

    rows = placed.where("kind <> 'part'").unionByName(staged(borders.mapInArrow(second, _SCHEMA), "borders"))
    return (rows.where("kind = 'record'").select("file", "offset", "length", *Record._fields),
            rows.where("kind = 'gap'").select("file", "offset", "length", "reason"))
