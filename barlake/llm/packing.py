"""Harmonic packing of tokenized documents into sequences of fixed capacity.

Piece lengths are partitioned into the reciprocal-capacity classes C/1, C/2,
C/4, ..., 1, and a sequence of class C/k takes exactly k pieces. A document may
be cut, so it is cut into pieces whose lengths are exactly those class lengths
(its whole sequences, then the binary digits of the rest, longest first): a
filled sequence then has no padding. Each worker fills the bins of its own
partition, without any exchange, and holds at most one open bin a class; at the
partition's end an open bin of m pieces is closed as bins of 2^i pieces, the
binary digits of m. Such a sequence is as long as a power of two, so it needs
no padding either.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .token_counts import Splitter
from .words import pieces, utf8

#: Distinct words whose ids a worker keeps; a cache only.
CACHE_WORDS = 500_000
#: sequence_id = partition << PARTITION_BITS | number within the partition.
PARTITION_BITS = 40

SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder(dict):
    """Bytes between two separators -> little-endian unsigned 32-bit ids, filled
    as they are met. The tokenizer drops ASCII white space and never merges
    across it, so a text's ids are those of its words in turn; pieces of words
    are encoded once, by the library's model."""

    def __init__(self, spec: str, end_id: int):
        super().__init__()
        self.splitter = Splitter(spec)
        self.model = self.splitter.library.model
        self.known = {"\0" + s: i.to_bytes(4, "little") for s, i in self.splitter.special_ids.items()}
        self.end = end_id.to_bytes(4, "little")

    def __missing__(self, raw: bytes) -> bytes:
        out = []
        for piece in self.splitter.pieces(raw):
            found = self.known.get(piece)
            if found is None:
                found = self.known[piece] = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(piece)])
            out.append(found)
        if len(self) >= CACHE_WORDS:
            self.clear()
            self.known = {k: v for k, v in self.known.items() if k[0] == "\0"}
        ids = self[raw] = b"".join(out)
        return ids

    def ids(self, text: bytes | None) -> bytes:
        """Of a whole text, with the end id."""
        out = [b"".join(map(self.__getitem__, piece.split())) for piece in pieces(text or b"")]
        return b"".join([*out, self.end])


def cuts(total: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    start = 0
    while total - start >= capacity:
        yield start, capacity
        start += capacity
    size = capacity
    while start < total:
        size >>= 1
        if total - start >= size:
            yield start, size
            start += size


class Bins:
    """The open bins of one worker. ``put`` and ``close`` return finished bins
    as (sequence_id, [(offset, piece)])."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list] = {}

    def _bin(self, size: int, held: list) -> tuple[int, list]:
        self.next_id += 1
        return self.next_id - 1, [(k * size, piece) for k, piece in enumerate(held)]

    def put(self, size: int, piece) -> list[tuple[int, list]]:
        held = self.open.setdefault(size, [])
        held.append(piece)
        return [self._bin(size, self.open.pop(size))] if len(held) * size == self.capacity else []

    def close(self) -> list[tuple[int, list]]:
        out = []
        for size, held in self.open.items():
            out += [self._bin(size, held[s:s + n]) for s, n in cuts(len(held), self.capacity // size)]
        self.open = {}
        return out


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
         end_id: int = 2) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset). Every token of every document, its end id included,
    lies in exactly one piece; offsets within a sequence are gapless from 0; a
    sequence is ``capacity`` or a smaller power of two long.

    ``capacity`` is a power of two. Defined cases: a null or empty text is its
    end id alone; ids may be null or repeated (every row is a document of its
    own); other columns are not looked at; an empty table gives an empty result.
    The packing depends on how the rows are partitioned, its cover does not."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(spec.value, end_id)
        bins = Bins(capacity, TaskContext.get().partitionId() << PARTITION_BITS)

        def rows(finished: list[tuple[int, list]]) -> Iterator[pa.RecordBatch]:
            flat = [(*piece, number, offset) for number, held in finished for offset, piece in held]
            if flat:
                ids, *rest = zip(*flat)
                yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), *(pa.array(x, pa.int64()) for x in rest)],
                                                 names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            id_type, finished = batch.column("id").type, []
            for key, text in zip(batch.column("id").to_pylist(), utf8(batch.column("t"))):
                ids = memoryview(encoder.ids(text))
                total = len(ids) // 4
                for start, length in cuts(total, capacity):
                    crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                    finished += bins.put(length, (key, start, length, crc, total))
            yield from rows(finished)
        yield from rows(bins.close())

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)
