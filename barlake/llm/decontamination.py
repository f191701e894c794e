"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

1. The items' word n-grams are set into a bitmap of bounded size. One pass over
   the corpus counts, for the n-grams that pass it, the documents they occur in.
2. Of every two consecutive n-grams of an item the rarer one that occurs in the
   corpus at all becomes a seed. So each item has seeds along its whole length,
   however often it was copied, and a frequent phrase rarely is one.
3. A second pass cuts out the passages around seeds (as word hashes) and joins
   them to the items on the seed.
4. Each (passage, item) pair is aligned locally. An item leaks into a document if
   the best alignment scores at least ``min_score`` of the item's own score, or
   ``min_run`` by itself: a part of an item, or an edited copy of a long one;
   replaced, inserted and dropped words cost one each.

Seeds only propose pairs; nothing is dropped for being frequent.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged
from .words import WordHashes, shingles, signed, utf8

#: Words of a seed, consecutive n-grams of which one is chosen, least share of an
#: item's score.
SEED_WORDS, BLOCK, MIN_SCORE = 3, 2, 0.5
#: Score of an aligned region that is a leak whatever the item's length: equal
#: words less edits. Chance pairs of sf0.1 that share three words in a row reach 6.
MIN_RUN = 10
#: The bitmap has 16 bits for each n-gram of the items, within these bounds.
LEAST_BITS, MOST_BITS = 1 << 18, 1 << 27

class Words(WordHashes):
    """Hashes of lower-cased words without punctuation: everything ASCII but
    letters and digits is a space."""

    table = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))

    def of(self, text: bytes | None) -> np.ndarray:
        if text and not text.isascii():
            text = text.decode("utf-8", "replace").lower().encode()
        return super().of(text)


def passing(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the bitmap has, by their low bits: all that were set, and
    perhaps others."""
    at = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(grams: DataFrame) -> Broadcast:
    """Of a column h of hashes. At most MOST_BITS / 8 bytes reach the driver and
    every executor."""
    bits = min(max(LEAST_BITS, 1 << (16 * grams.count()).bit_length()), MOST_BITS)
    at = grams.select(F.col("h").bitwiseAND(F.lit(bits - 1)).alias("at"))
    chunk = at.groupBy(F.shiftright("at", 15).alias("chunk")).agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit((1 << 15) - 1))).alias("m"))
    words = np.zeros(bits // 8, np.uint8)
    for row in chunk.toLocalIterator():
        words[row.chunk << 12:(row.chunk << 12) + (1 << 12)] = np.frombuffer(bytes(row.m), np.uint8)
    return grams.sparkSession.sparkContext.broadcast(words)


def _item_rows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, words, grams) of items with at least SEED_WORDS words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Words()
        for batch in batches:
            words = [hashes.of(t) for t in utf8(batch.column("t"))]
            grams = [shingles(w, SEED_WORDS) if len(w) >= SEED_WORDS else None for w in words]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), pa.array([signed(w) for w in words], longs),
                 pa.array([None if g is None else signed(g) for g in grams], longs)], names=["item", "words", "grams"])

    rows = items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("t")).distinct()
    return rows.where("item IS NOT NULL").mapInArrow(run, "item long, words array<long>, grams array<long>").where("grams IS NOT NULL")


def _document_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("t"))


def _frequencies(rows: DataFrame, known: Broadcast) -> DataFrame:
    """(h, df) of the n-grams that pass the bitmap, counted in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Words()
        for batch in batches:
            counts: Counter = Counter()
            for text in utf8(batch.column("t")):
                grams = shingles(hashes.of(text), SEED_WORDS)
                counts.update(set(signed(grams[passing(known.value, grams)]).tolist()))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
                                             names=["h", "df"])

    return rows.select("t").mapInArrow(run, "h long, df long").groupBy("h").agg(F.sum("df").alias("df"))


def _passages(rows: DataFrame, known: Broadcast, margin: int) -> DataFrame:
    """(id, text_hash, start, words, seeds): stretches of a document with
    ``margin`` words around seeds; stretches that meet are one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Words()
        for batch in batches:
            out = []
            for key, text_hash, text in zip(batch.column("id").to_pylist(), batch.column("text_hash").to_pylist(),
                                            utf8(batch.column("t"))):
                words = hashes.of(text)
                if len(words) < SEED_WORDS:
                    continue
                grams = shingles(words, SEED_WORDS)
                at = np.flatnonzero(passing(known.value, grams))
                for run_ in np.split(at, np.flatnonzero(np.diff(at) > 2 * margin) + 1) if len(at) else ():
                    start, stop = max(0, int(run_[0]) - margin), int(run_[-1]) + SEED_WORDS + margin
                    out.append((key, text_hash, start, signed(words[start:stop]), signed(np.unique(grams[run_]))))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, [pa.int64()] * 3 + [longs] * 2)],
                names=["id", "text_hash", "start", "words", "seeds"])

    return rows.mapInArrow(run, "id long, text_hash long, start long, words array<long>, seeds array<long>")


def best_end(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """(score, end in a, end in b) of the best local alignment: +1 for equal
    words, -1 for a replaced, inserted or dropped one. Row by row; gaps along a
    row are a running maximum."""
    steps = np.arange(len(b) + 1, dtype=np.int32)
    row, top = np.zeros(len(b) + 1, np.int32), (0, 0, 0)
    for i, word in enumerate(a):
        new = np.maximum(row - 1, 0)
        np.maximum(new[1:], row[:-1] + np.where(b == word, 1, -1), out=new[1:])
        row = np.maximum.accumulate(new + steps) - steps
        j = int(row.argmax())
        if row[j] > top[0]:
            top = (int(row[j]), i + 1, j)
    return top


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """(score, start, stop): the best local alignment and its place in ``passage``."""
    score, i, j = best_end(item, passage)
    if not score:
        return 0, 0, 0
    _, _, back = best_end(item[:i][::-1], passage[:j][::-1])
    return score, j - back, j


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", min_score: float = MIN_SCORE,
          min_run: int | None = None) -> DataFrame:
    """(id, text_hash, item, score, start, stop): one row for every document and
    benchmark item that leaks into it, with the alignment's share of the item's
    score and its place in words. ``min_run``: also alignments of that score (see
    MIN_RUN), though a smaller share of the item's.

    Words are lower-cased and stripped of ASCII punctuation. Defined cases: null
    and empty texts, texts and items with fewer than SEED_WORDS words, and items
    with a null id match nothing; exactly repeated documents give one row; a
    document with a null id gives rows with a null id; other columns are not
    looked at; an empty table on either side gives an empty result."""
    found = staged(_item_rows(items, item_col, item_text_col), "items")
    grams = staged(found.select("item", F.posexplode("grams").alias("at", "h")), "grams")
    margin = (found.agg(F.max(F.size("words"))).first()[0] or 0) + SEED_WORDS
    rows = _document_rows(docs, id_col, text_col)
    df = _frequencies(rows, bitmap(grams.select("h")))
    some = grams.join(df, "h").groupBy("item", F.floor(F.col("at") / BLOCK).alias("block")).agg(
        F.min_by("h", F.struct("df", "at")).alias("h"))
    seeds = staged(some.select("item", "h").distinct(), "seeds")

    passages = staged(_passages(rows, bitmap(seeds.select("h")), margin), "passages")
    key = ["id", "text_hash", "start"]
    named = passages.select(*key, F.explode("seeds").alias("h")).join(seeds, "h").select(*key, "item").distinct()
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"n.{c}")) for c in key]
    pairs = named.alias("n").join(passages.drop("seeds").alias("p"), same).select("p.*", "n.item")
    pairs = pairs.join(found.select("item", F.col("words").alias("item_words")), "item")
    pairs = pairs.select(*key, "item", "words", "item_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, wanted = batch.column("words"), batch.column("item_words")
            flat, at = words.values.to_numpy(), words.offsets.to_numpy()
            item_flat, item_at = wanted.values.to_numpy(), wanted.offsets.to_numpy()
            got = []
            for k, start in enumerate(batch.column("start").to_pylist()):
                item = item_flat[item_at[k]:item_at[k + 1]]
                score, first, stop = align(item, flat[at[k]:at[k + 1]])
                got.append((score / len(item), start + first, start + stop, score))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), batch.column("item"),
                 *(pa.array(c, t) for c, t in zip(zip(*got) if got else [[]] * 4, (pa.float64(), *[pa.int64()] * 3)))],
                names=["id", "text_hash", "item", "score", "start", "stop", "run"])

    scored = pairs.mapInArrow(run, "id long, text_hash long, item long, score double, start long, stop long, run long")
    enough = F.col("score") >= min_score
    if min_run is not None:
        enough |= F.col("run") >= min_run
    best = scored.where(enough).groupBy("id", "text_hash", "item").agg(
        F.max(F.struct("score", -F.col("start"), "stop")).alias("best"))
    return best.select("id", "text_hash", "item", F.col("best.score").alias("score"), (-F.col("best.col2")).alias("start"),
                       F.col("best.stop").alias("stop"))
