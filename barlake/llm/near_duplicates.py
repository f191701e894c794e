"""MinHash near-duplicates: one-permutation hashing with optimal densification,
banded buckets, and star-shaped candidate edges confirmed on full shingle sets.

Candidates. Equal shingle sets are folded into one node first (by a 128-bit
fingerprint), so copies never meet in a bucket. Every node is sketched with one
pass over its shingles and put into ``bands`` buckets; a pair at the threshold
misses all of them with probability below ``MISS``. A bucket is joined as stars:

1. every node is compared with one centre, the smallest node of the bucket it
   shares most often, and the links are contracted to components;
2. in buckets that still hold several components every member of another
   component than the centre's is compared with the centre;
3. the nodes of buckets that still hold several components are joined across
   components by the exact prefix filter (see :func:`_rest`).

So a large group of near copies costs about one comparison a node, its members
are never paired with each other, and no pair that shares a bucket is left out.

Comparisons recompute the shingle sets from whole texts: a centre's text goes
once to every block of at most ``BLOCK`` of its partners.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.series import POS, with_position
from .components import components
from .decontamination import bitmap, passing
from .staging import staged
from .words import WordHashes, mix, shingles, signed, utf8

#: Sketch values in a band, and the accepted chance of missing a pair that lies
#: exactly at the threshold.
ROWS, MISS = 5, 1e-7
#: Partners of a centre that are compared in one group.
BLOCK = 256
#: Nodes of a shingle's prefixes in a block, and ways in which a shingle's rows part
#: before their number is known.
PREFIX_BLOCK, SALT = 256, 16


def band_count(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log1p(-similarity ** rows))


class Sketch:
    """One-permutation MinHash. The hash range is cut into ``bins`` and a bin's
    value is its smallest hash; an empty bin borrows the value of the first
    non-empty bin in a probe order of its own (the same for every text)."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        width = 1 << 10
        grid = np.arange(self.bins * width, dtype=np.uint64) + np.uint64(0x5DEECE66D)
        self.probes = (mix(grid) % np.uint64(self.bins)).astype(np.int32).reshape(self.bins, width)
        self.edges = np.array([-(-(i << 64) // self.bins) for i in range(1, self.bins)], dtype=np.uint64)

    def bins_of(self, distinct: np.ndarray) -> np.ndarray:
        """``distinct``: sorted hashes, at least one."""
        starts = np.concatenate(([0], np.searchsorted(distinct, self.edges)))
        full = np.append(starts[1:], len(distinct)) > starts
        values = distinct[np.minimum(starts, len(distinct) - 1)]
        empty, at = np.flatnonzero(~full), 0
        for width in (8, 64, self.probes.shape[1]):
            if not len(empty):
                break
            tried = full[self.probes[empty, at:width]]
            hit = tried.any(axis=1)
            values[empty[hit]] = values[self.probes[empty[hit], at + tried[hit].argmax(axis=1)]]
            empty, at = empty[~hit], width
        if len(empty):  # not even 1,024 probes met a full bin: the next one to the right
            there = np.flatnonzero(full)
            values[empty] = values[there[np.searchsorted(there, empty) % len(there)]]
        return values

    def buckets(self, distinct: np.ndarray) -> np.ndarray:
        """One bucket key for every band."""
        grid = self.bins_of(distinct).reshape(self.bands, self.rows)
        key = mix(np.arange(self.bands, dtype=np.uint64) + np.uint64(1))
        for column in grid.T:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
        return key


def _sketched(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sketch = WordHashes(), Sketch(bands, ROWS)
        for batch in batches:
            sizes, prints, keys = [], [], []
            for text in utf8(batch.column("t")):
                found = np.unique(shingles(hashes.of(text), words))
                sizes.append(len(found))
                prints.append(blake2b(found.tobytes(), digest_size=16).digest())
                keys.append(signed(sketch.buckets(found)) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["id", "text_hash", "n", "print", "keys"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("t"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, text_hash long, n long, print binary, keys array<long>")


def _compared(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(a, b, both): shingles that the texts of nodes a and b share, on full
    sets. ``pairs`` is distinct; ``texts`` has (node, t), also repeatedly."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    put = pairs.join(many, "a").select("a", F.pmod(F.xxhash64("b"), "blocks").alias("block"), "b")
    centres = put.select("a", "block").distinct().select("a", "block", F.col("a").alias("node"))
    wanted = centres.unionByName(put.select("a", "block", F.col("b").alias("node")))
    rows = wanted.join(texts, "node").select("a", "block", "node", (F.col("node") != F.col("a")).alias("partner"), "t")
    rows = rows.repartition("a", "block").sortWithinPartitions("a", "block", "partner", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, group, centre, last = WordHashes(), None, None, None
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for a, block, node, text in zip(*(batch.column(c).to_pylist() for c in ("a", "block", "node")),
                                            utf8(batch.column("t"))):
                if (a, block, node) == last:
                    continue
                last = (a, block, node)
                found = np.unique(shingles(hashes.of(text), words))
                if (a, block) != group:
                    group, centre = (a, block), found
                else:
                    out.append((a, node, len(np.intersect1d(centre, found, assume_unique=True))))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)] or [pa.array([], pa.int64())] * 3,
                                             names=["a", "b", "both"])

    return rows.mapInArrow(run, "a long, b long, both long")


class _Links:
    """Comparisons made so far, and the components of the confirmed links."""

    def __init__(self, texts: DataFrame, words: int, percent: int):
        self.texts, self.words, self.percent = texts, words, percent
        self.tested: DataFrame | None = None
        self.labels: DataFrame | None = None

    def close(self, size_a: str, size_b: str):
        """Sizes that allow a link at all."""
        return 100 * F.least(size_a, size_b) >= self.percent * F.greatest(size_a, size_b)

    def add(self, pairs: DataFrame) -> None:
        """Compare (a, na, b, nb) pairs that have not been compared."""
        if self.tested is not None:
            pairs = pairs.join(self.tested.select("a", "b"), ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        if pairs.isEmpty() and self.tested is not None:
            return
        new = _compared(pairs.select("a", "b"), self.texts, self.words).join(pairs, ["a", "b"]).select(
            "a", "b", "both", (F.col("na") + F.col("nb") - F.col("both")).alias("either"))
        new = staged(new, "compared")
        self.tested = new if self.tested is None else self.tested.unionByName(new)
        linked = self.tested.where(100 * F.col("both") >= self.percent * F.col("either"))
        self.labels = components(linked)

    def labelled(self, members: DataFrame, node: str, name: str) -> DataFrame:
        to = self.labels.select(F.col("node").alias(node), F.col("component").alias(name))
        return members.join(to, node, "left").withColumn(name, F.coalesce(name, node))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80) -> DataFrame:
    """One row per document: (id, n_shingles, component_id, kept, text_hash).

    Two documents are linked if ``100 * |A and B| >= percent * |A or B|`` for
    their sets of distinct ``words``-word shingles. component_id is the smallest
    id reachable over links, kept says whether that is the document itself.

    Defined cases: a null or empty text, or one without words, has no shingles
    and is linked with nothing; a text with fewer words than a shingle is one
    shingle as a whole. Every row gives a row: repeated rows have equal results,
    rows with one id but several texts are judged, and linked, by their own
    text. Ids are of any type that has an order. A
    row with a null id has no node: its component_id is null and it is kept. Other
    columns of ``docs`` are not looked at. An empty table gives an empty result."""
    bands = band_count(percent / 100)
    rows = staged(_sketched(docs, id_col, text_col, words, bands), "sketches")
    solid = rows.where("id IS NOT NULL AND n > 0")
    # A node is a set of shingles, whatever rows have it; its row of the smallest id stands
    # for it. Nodes are numbered in the order of ids: originals come before their copies,
    # and as the centres of stars they have the fewest pairs.
    first = solid.groupBy("print").agg(F.min(F.struct("id", "text_hash")).alias("row")).select("print", "row.id", "row.text_hash")
    first = with_position(staged(first, "prints"), [], ["id", "text_hash", "print"]).withColumnRenamed(POS, "node")
    first = staged(first, "nodes")
    reps = solid.join(first, ["print", "id", "text_hash"])
    member = reps.select("node", "n", F.explode("keys").alias("bucket"))
    centre = member.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").drop("z")
    members = staged(member.join(centre, "bucket").select("bucket", "a", F.col("node").alias("b"), F.col("n").alias("nb")),
                     "members")

    sizes = staged(members.groupBy("b").agg(F.max("nb").alias("nb")), "sizes")
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("t"))
    wanted = first.join(sizes.select(F.col("b").alias("node")), "node", "left_semi").drop("print")
    texts = staged(texts.join(wanted, ["id", "text_hash"]).select("node", "t"), "texts")
    na = sizes.select(F.col("b").alias("a"), F.col("nb").alias("na"))
    links = _Links(texts, words, percent)

    spokes = members.where("a <> b").groupBy("b", "a").agg(F.count("*").alias("shared"), F.max("nb").alias("nb"))
    spokes = staged(spokes.join(na, "a").where(links.close("na", "nb")), "spokes")
    best = spokes.groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a"))
    links.add(spokes.join(best, ["a", "b"]).select("a", "na", "b", "nb"))

    open_ = links.labelled(links.labelled(spokes, "a", "ca"), "b", "cb").where("ca <> cb")
    links.add(open_.select("a", "na", "b", "nb"))

    links.add(_rest(links, members))
    return _labelled(rows, first, links.labels, id_col)


def _rest(links: _Links, members: DataFrame) -> DataFrame:
    """Pairs that the stars left open: nodes of buckets that hold several
    components beside the centre, where the pair passes the prefix filter, which
    is exact.

    With a node's shingles in one order for all, rarest first, two linked sets
    share one among their first n - ceil(threshold * n) + 1, and early enough
    that what follows can still make up the overlap. Shingles that only one node
    has fill the prefixes of nodes with many edits, so a large group of loosely
    similar texts gives few pairs. Each such shingle is joined from the nodes
    outside its first component."""
    # pairs with the centre have all been compared, or their sizes exclude a link
    at = links.labelled(members.where("a <> b"), "b", "c")
    mixed = at.groupBy("bucket").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
    nodes = at.join(mixed, "bucket", "left_semi").select(F.col("b").alias("node"), F.col("nb").alias("n"), "c").distinct()
    nodes, words = staged(nodes, "open"), links.words

    def rows(held: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        nodes_ = np.repeat(np.array([n for n, _ in held], np.int64), [len(f) for _, f in held])
        return pa.RecordBatch.from_arrays([pa.array(nodes_), pa.array(signed(np.concatenate([f for _, f in held])))],
                                          names=["node", "shingle"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            held, size = [], 0
            wanted = passing(known.value, batch.column("h").to_numpy().view(np.uint64))
            batch = batch.filter(pa.array(wanted))
            for node, text in zip(batch.column("node").to_pylist(), utf8(batch.column("t"))):
                found = np.unique(shingles(hashes.of(text), words))
                held.append((node, found))
                size += len(found)
                if size >= 1 << 18:
                    yield rows(held)
                    held, size = [], 0
            if held:
                yield rows(held)

    # a bitmap of bounded size picks the texts; the few others it lets pass only
    # count in the order, and leave with the join below
    known = bitmap(nodes.select(F.xxhash64("node").alias("h")))
    texts = links.texts.select("node", F.xxhash64("node").alias("h"), "t")
    held = staged(texts.mapInArrow(run, "node long, shingle long"), "shingles")
    shared = held.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    ordered = held.join(shared, "shingle", "left").groupBy("node").agg(
        F.sort_array(F.collect_set(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "shingle"))).alias("order"))
    n, percent = F.col("n"), links.percent
    length = (n - F.ceil(percent * n / 100) + 1).cast("int")
    prefix = ordered.join(nodes, "node").select("node", "n", "c", F.posexplode(F.slice("order", F.lit(1), length)).alias("at", "s"))
    prefix = staged(prefix.where("s.df > 1").select("node", "n", "c", "at", F.col("s.shingle").alias("shingle")), "prefix")

    # A shingle may be in many prefixes: its nodes are dealt into blocks, and every
    # block meets every other one under a key of its own.
    bounds = prefix.groupBy("shingle").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("nodes")).where("low <> high")
    bounds = bounds.select("shingle", "low", F.ceil(F.col("nodes") / PREFIX_BLOCK).alias("blocks"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    salted = prefix.withColumn("salt", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(SALT)).cast("int"))
    inner = salted.join(bounds, ["shingle", "salt"]).withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    outer = inner.where("c <> low").select("shingle", F.col("own").alias("first"), every.alias("second"), *(F.col(x).alias(f"o_{x}") for x in ("node", "n", "c", "at")))
    inner = inner.select("shingle", every.alias("first"), F.col("own").alias("second"), "node", "n", "c", "at")
    left = F.least(n - F.col("at"), F.col("o_n") - F.col("o_at"))
    pairs = outer.join(inner, ["shingle", "first", "second"]).where((F.col("c") != F.col("o_c")) & links.close("n", "o_n")
                                               & (percent * (n + F.col("o_n")) <= (100 + percent) * left))
    ends = [F.struct(F.col("node").alias("id"), "n"), F.struct(F.col("o_node").alias("id"), F.col("o_n").alias("n"))]
    pairs = pairs.select(F.least(*ends).alias("x"), F.greatest(*ends).alias("y"))
    return pairs.select(F.col("x.id").alias("a"), F.col("x.n").alias("na"), F.col("y.id").alias("b"),
                        F.col("y.n").alias("nb")).distinct()


def _labelled(rows: DataFrame, first: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    linked = first.select("node", "id").join(labels, "node")
    lowest = linked.groupBy("component").agg(F.min("id").alias("low"))
    of = staged(labels.join(lowest, "component").select("node", "low"), "lowest")
    named = first.join(of, "node", "left").select("print", F.coalesce("low", "id").alias("component_id"))
    out = rows.select("id", "text_hash", "n", "print").join(named, "print", "left")
    alone = (F.col("n") == 0) | F.col("id").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"), "text_hash")
