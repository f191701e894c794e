"""Importance resampling towards a target distribution by bit-sliced aggregation.

Texts become bags of hashed n-grams of words. The corpus and the target are
counted by bucket; a bucket's gain says how much more often the target uses it.
A document's weight is the sum of the gains of its n-grams:

* its bucket counts are cut into planes of one bit a bucket (plane i has bit i of
  every count), the gains into planes of their magnitudes' bits, positive and
  negative ones apart;
* weight = sum over planes of 2^(i + j) * (popcount(counts_i & positive_j) -
  popcount(counts_i & negative_j)), in integers, so it is exact.

Documents are drawn without replacement by Gumbel noise on their weights, the
noise coming from a hash of the id. The rank among all drawn is a range-sorted
position, not a window in one task.

The gains (one number a bucket) are all that reaches the driver and the
executors; the corpus is read twice and never shuffled, only bucket counts are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.series import POS, with_position
from .staging import staged
from .words import PIECE_BYTES, pieces, utf8

#: Defaults: buckets, longest n-gram, least words of a drawn document, scale of
#: gains and noise.
BUCKETS, NGRAM, LEAST_WORDS, SCALE = 10000, 3, 20, 1000
#: Words of up to this many bytes are hashed all at once, longer ones singly.
SHORT_WORD = 48
#: Documents whose counts and planes are held at a time.
DOCS_AT_ONCE = 64

#: Bytes that belong to words: digits, letters (lower-cased) and all non-ASCII.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def _byte_steps() -> np.ndarray:
    """The CRC-32 register after one byte, for each low byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    return table


def _shifts(longest: int) -> np.ndarray:
    """[n, k, v]: what byte k with value v of a CRC turns into when n bytes follow;
    crc(a + b) is the XOR of these over the four bytes of crc(a), and crc(b)."""
    step, out = _byte_steps(), np.empty((longest + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, longest + 1):
        out[n] = step[out[n - 1] & 255] ^ (out[n - 1] >> np.uint32(8))
    return out


class NgramHashes:
    """CRC-32 of all runs of 1 to ``most`` words (joined by a space) of many texts at a time."""

    def __init__(self, most: int = NGRAM) -> None:
        self.most, self.step, self.shift = most, _byte_steps(), _shifts(SHORT_WORD + 1).reshape(-1)

    def items(self, texts: Iterator[bytes | None]) -> Iterator[list[tuple[int, bytes, int]]]:
        """(number of the text, piece, leading words that only serve n-grams across
        its border), in lists of bounded size."""
        held, size = [], 0
        for k, text in enumerate(texts):
            before: list[bytes] = []
            for piece in pieces((text or b"").translate(_LOWER)):
                held.append((k, b" ".join([*before, piece]), len(before)))
                size += len(piece)
                last = piece.rsplit(None, self.most - 1)[-(self.most - 1):] if self.most > 1 else []
                before = [w for w in (before + last) if w][-(self.most - 1):] if self.most > 1 else []
                if size >= PIECE_BYTES or held[-1][0] - held[0][0] + 1 >= DOCS_AT_ONCE:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def of(self, items: list[tuple[int, bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item of every n-gram, its hash, words of every item)."""
        flat = b" ".join(piece for _, piece, _ in items)
        codes = np.frombuffer(flat, np.uint8)
        solid = np.zeros(len(codes) + 2, np.int8)
        solid[1:-1] = codes != 32
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        offsets = np.cumsum([0, *(len(piece) + 1 for _, piece, _ in items)])[:-1]
        owner = np.searchsorted(offsets, starts, side="right") - 1
        place = np.arange(len(starts)) - np.searchsorted(owner, np.arange(len(items)))[owner]
        fresh = place >= np.array([old for _, _, old in items])[owner]
        long_words = [(int(k), flat[starts[k]:starts[k] + lengths[k]]) for k in np.flatnonzero(lengths > SHORT_WORD)]
        short = np.where(lengths > SHORT_WORD, 0, lengths)

        single = self._words(codes, starts, short)
        spaced = self._joined(np.full(len(single), crc32(b" "), np.uint32), single, short)
        for k, word in long_words:
            single[k], spaced[k] = crc32(word), crc32(b" " + word)
        owners, hashes, run = [owner[fresh]], [single[fresh]], single
        for n in range(2, self.most + 1):
            if len(run) < 2:
                break
            prior, run = run[:-1], self._joined(run[:-1], spaced[n - 1:], short[n - 1:] + 1)
            for k, word in long_words:
                if k >= n - 1:
                    run[k - n + 1] = crc32(b" " + word, int(prior[k - n + 1]))
            whole = (owner[n - 1:] == owner[:len(run)]) & fresh[n - 1:]
            owners.append(owner[n - 1:][whole])
            hashes.append(run[whole])
        return np.concatenate(owners), np.concatenate(hashes), np.bincount(owner[fresh], minlength=len(items))

    def _words(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """CRC of every word: one byte of all words that have it at a time."""
        order = np.argsort(-lengths, kind="stable")
        starts, state = starts[order], np.full(len(starts), 0xFFFFFFFF, np.uint32)
        longer = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), side="left")
        for k, n in enumerate(longer):
            state[:n] = self.step[(state[:n] ^ codes[starts[:n] + k]) & 255] ^ (state[:n] >> np.uint32(8))
        out = np.empty_like(state)
        out[order] = state ^ np.uint32(0xFFFFFFFF)
        return out

    def _joined(self, left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
        at, out = length * 1024, right.copy()
        for k in range(4):
            out ^= self.shift[at + 256 * k + ((left >> np.uint32(8 * k)) & np.uint32(255))]
        return out


def bucket_totals(texts: DataFrame, column: str, buckets: int = BUCKETS, ngram: int = NGRAM) -> DataFrame:
    """(bucket, n): n-grams of all texts by bucket; summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = NgramHashes(ngram), np.zeros(buckets, np.int64)
        for batch in batches:
            for items in hashes.items(utf8(batch.column(0))):
                total += np.bincount(hashes.of(items)[1] % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    rows = texts.select(F.col(column).cast("string").alias("t"))
    return rows.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS, scale: int = SCALE) -> np.ndarray:
    """Of every bucket: floor(scale * ln of target frequency over corpus frequency),
    add-one smoothed. ``buckets`` rows a side are collected."""
    s, t = np.zeros(buckets, object), np.zeros(buckets, object)
    for into, totals in ((s, corpus), (t, target)):
        for row in totals.toLocalIterator():
            into[row.bucket] = int(row.n)
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(scale * math.log((float(b + 1) * all_s) / (float(a + 1) * all_t))) for a, b in zip(s, t)], np.int64)


def planes(values: np.ndarray) -> np.ndarray:
    """[bit, row, 64-bit word]: bit j of every value of a matrix of magnitudes."""
    most = int(values.max(initial=0))
    values = values.astype(np.uint16) if most < 1 << 16 else values
    out = np.zeros((max(most.bit_length(), 1), len(values), -(-values.shape[1] // 64) * 8), np.uint8)
    for j, plane in enumerate(out):
        bits = np.packbits((values >> j) & 1, axis=1, bitorder="little")
        plane[:, :bits.shape[1]] = bits
    return out.view(np.uint64)


def weigh(counts: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    """Of every row of ``counts``: its product with the gains, from the planes of
    their positive and negative parts."""
    out = np.zeros(len(counts), np.int64)
    for i, plane in enumerate(planes(counts)):
        for sign, gain in ((1, positive), (-1, negative)):
            for j, row in enumerate(gain):
                out += (sign << (i + j)) * np.bitwise_count(plane & row).sum(axis=1, dtype=np.int64)
    return out


def weights(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, ngram: int = NGRAM) -> DataFrame:
    """(id, n_words, n_features, weight), one row a document."""
    buckets = len(gain)
    positive, negative = planes(np.maximum(gain, 0)[None, :]), planes(np.maximum(-gain, 0)[None, :])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = NgramHashes(ngram)
        for batch in batches:
            words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for items in hashes.items(utf8(batch.column("t"))):
                owner, found, lengths = hashes.of(items)
                text = np.array([k for k, _, _ in items])
                first, local = text[0], text - text[0]
                keys = local[owner] * buckets + found % np.uint32(buckets)
                counts = np.bincount(keys, minlength=(local[-1] + 1) * buckets).reshape(-1, buckets)
                at = slice(first, first + len(counts))
                np.add.at(words, text, lengths)
                features[at] += counts.sum(axis=1)
                weight[at] += weigh(counts, positive, negative)
            new = [pa.array(v, pa.int64()) for v in (words, features, weight)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *new], names=["id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", buckets: int = BUCKETS, ngram: int = NGRAM, least_words: int = LEAST_WORDS,
             seed: int = 42, scale: int = SCALE) -> DataFrame:
    """(id_col, n_words, n_features, weight, score, rank), one row a document. Of the
    documents with ``least_words`` words or more, ``percent`` in a hundred are drawn:
    those of the highest scores (weight plus noise), ties to the smaller id; rank
    counts them from 1 and is null for all others.

    Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased.
    Defined cases: null and empty texts have no features, weight 0 and are never
    drawn; a null id draws its noise from the seed alone and comes first among
    ties; ids are of any type, compared as they are; repeated rows are documents of
    their own, with equal scores and ranks that follow each other; words and texts
    of any length count in full; an empty target gives gains by the corpus alone,
    an empty corpus an empty result; other columns are not looked at."""
    gain = gains(bucket_totals(docs, text_col, buckets, ngram), bucket_totals(target, target_text_col, buckets, ngram), buckets, scale)
    scored = weights(docs, gain, id_col, text_col, ngram).withColumn("score", F.col("weight") + _noise(seed, scale))
    scored = staged(scored, "weights")
    fit, rest = scored.where(F.col("n_words") >= least_words), scored.where(F.col("n_words") < least_words)
    drawn = fit.count() * percent // 100
    placed = with_position(fit.withColumn("_down", -F.col("score")), [], ["_down", "id"])
    ranked = placed.select(*scored.columns, F.when(F.col(POS) < drawn, F.col(POS) + 1).alias("rank"))
    out = ranked.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", "rank")


def _noise(seed: int, scale: int) -> Column:
    """Gumbel noise: floor(-scale * ln(-ln u)), u from a hash of the id."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(F.lit(-float(scale)) * F.log(-F.log(u))).cast("long")
