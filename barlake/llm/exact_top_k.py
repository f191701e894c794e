"""Exact top-k inner products with block-at-a-time pruning.

Vectors become integer codes, and each range of ids becomes a block: a forward
index (its code matrix) with the largest and smallest code of every term. A
block's bound for a query is the sum over terms of the larger product, so no
vector of the block can score more.

Three distributed steps, each on pairs of a query block and a document block:

1. bounds of all pairs, from the block summaries alone, order the blocks of each
   query;
2. the best-bounded block of each query is scored; its k-th score is a threshold
   that the k-th best of all blocks cannot fall below;
3. of the remaining blocks those whose bound reaches the threshold are scored,
   the rest is pruned.

The queries are a stated subset of the rows. Nothing is broadcast or collected:
summaries and matrices meet by shuffles on their block numbers, and every task
holds one pair of blocks of fixed size at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged

#: Vectors in a document block and in a query block, and document blocks whose
#: summaries are bounded together.
DOC_BLOCK, QUERY_BLOCK, GROUP = 1024, 512, 256

_BLOCK = "block long, dim int, n int, ids binary, codes binary, high binary, low binary"
_BLOCK_NAMES = ["block", "dim", "n", "ids", "codes", "high", "low"]
_BLOCK_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


def codes_of(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, codes): floor(scale * x) of every component, for vectors without null
    or non-finite components and with an id."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: F.coalesce((v == v) & (F.abs(v) < float("inf")), F.lit(False)))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.when(finite, x).alias("x")).where(
        "id IS NOT NULL AND x IS NOT NULL")
    return rows.select("id", F.transform("x", lambda v: F.floor(v * F.lit(scale))).alias("codes"))


def _blocks(codes: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors of one dimension, in ranges of ids.
    Equal rows are taken once."""
    rows = codes.repartitionByRange("id").sortWithinPartitions("id", "codes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}
        last = None

        def block(dim: int) -> pa.RecordBatch:
            nonlocal number
            rows_ = held.pop(dim)
            matrix = np.array([c for _, c in rows_], np.int64).reshape(len(rows_), dim)
            ids = np.array([i for i, _ in rows_], np.int64)
            values = [number, dim, len(rows_), ids.tobytes(), _packed(matrix), _packed(matrix.max(axis=0)),
                      _packed(matrix.min(axis=0))]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _BLOCK_TYPES)], names=_BLOCK_NAMES)

        for batch in batches:
            column = batch.column("codes")
            flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            for k, key in enumerate(batch.column("id").to_pylist()):
                row = flat[offsets[k]:offsets[k + 1]]
                if last is not None and key == last[0] and np.array_equal(row, last[1]):
                    continue
                last = (key, row)
                held.setdefault(len(row), []).append(last)
                if len(held[len(row)]) == size:
                    yield block(len(row))
        for dim in list(held):
            yield block(dim)

    return rows.mapInArrow(run, _BLOCK)


def _packed(matrix: np.ndarray) -> bytes:
    """Codes in 2 bytes each where they fit, after a byte that says so."""
    small = not matrix.size or int(np.abs(matrix).max()) < 1 << 15
    return (b"h" + matrix.astype(np.int16).tobytes()) if small else b"q" + matrix.tobytes()


def _matrix(data: bytes, dim: int, rows: int = 1) -> np.ndarray:
    return np.frombuffer(data, np.dtype(chr(data[0])), offset=1).astype(np.int64).reshape(rows, dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows; by floating point where that is exact."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """queries x blocks: the most that any vector of a block can score."""
    return products(np.maximum(queries, 0), high) + products(np.minimum(queries, 0), low)


def best(scores: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(query, id, score) of the k best candidates of every query, its own id
    excepted; equal scores by smaller id. ``ids`` is sorted."""
    for q, row in zip(query_ids, scores):
        other = ids != q
        values, names = row[other], ids[other]
        if len(values) > k:
            cut = np.partition(values, len(values) - k)[len(values) - k]
            near = np.flatnonzero(values >= cut)  # ties included
            values, names = values[near], names[near]
        for at in np.lexsort((names, -values))[:k]:
            yield int(q), int(names[at]), int(values[at])


def _scored(pairs: DataFrame, queries: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """The k best of every (query block, document block) pair. ``pairs`` lists
    the queries of a pair that want it (positions in the query block)."""
    rows = pairs.join(queries.select(F.col("block").alias("qblock"), "dim", F.col("ids").alias("qids"),
                                     F.col("codes").alias("qcodes")), "qblock")
    rows = rows.join(blocks.select("block", "ids", "codes"), "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                wants = np.array(get["wants"], np.int64)
                qids, ids = np.frombuffer(get["qids"], np.int64), np.frombuffer(get["ids"], np.int64)
                q, d = _matrix(get["qcodes"], get["dim"], len(qids))[wants], _matrix(get["codes"], get["dim"], len(ids))
                found = list(zip(*best(products(q, d), qids[wants], ids, k)))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found or [[], [], []]],
                                                 names=["query_id", "vec_id", "score"])

    return rows.select("dim", "wants", "qids", "qcodes", "ids", "codes").mapInArrow(
        run, "query_id long, vec_id long, score long")


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256,
                query_every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products
    of every query (rows whose id is divisible by ``query_every``) with all other
    rows, ties to the smaller id.

    Defined cases: null vectors, vectors with null or non-finite components and
    rows with a null id take no part; an empty vector takes part with score 0
    against other empty ones; vectors of different lengths are not compared;
    exactly repeated rows count once, and no row with the query's id is a
    candidate; a query with fewer candidates has fewer rows; an empty table gives
    an empty result."""
    codes = codes_of(df, id_col, vector_col, scale)
    blocks = staged(_blocks(codes, DOC_BLOCK), "blocks")
    queries = staged(_blocks(codes.where(F.pmod("id", F.lit(query_every)) == 0), QUERY_BLOCK), "queries")
    wide = staged(_bounded(blocks, queries), "bounds")

    hits = staged(_scored(wide.where("seed").select("qblock", "block", "wants"), queries, blocks, k), "seeds")
    kth = _ranked(hits, k).groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n"))
    kth = kth.where(F.col("n") == k).select("query_id", "floor")
    asked = wide.where("NOT seed").select("qblock", "block", F.posexplode(F.arrays_zip("wants", "query_ids", "reach")))
    asked = asked.select("qblock", "block", F.col("col.wants").alias("want"), F.col("col.query_ids").alias("query_id"),
                         F.col("col.reach").alias("reach"))
    asked = asked.join(kth, "query_id", "left").where("floor IS NULL OR reach >= floor")
    asked = asked.groupBy("qblock", "block").agg(F.collect_list("want").alias("wants"))
    more = _scored(asked, queries, blocks, k)
    return _ranked(hits.unionByName(more), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _bounded(blocks: DataFrame, queries: DataFrame) -> DataFrame:
    """(qblock, block, seed, wants, query_ids, reach): for each pair of blocks of
    one dimension the queries (positions, ids) with their bounds, in a row of its
    own (seed) those whose best-bounded block of its group this is."""
    summaries = blocks.select("block", "dim", "high", "low")
    groups = max(1, -(-summaries.count() // GROUP))
    summaries = summaries.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(groups)))
    grouped = summaries.groupBy("dim", "part").agg(F.collect_list(F.struct("block", "high", "low")).alias("blocks"))
    asked = queries.select(F.col("block").alias("qblock"), "dim", "ids", "codes",
                           F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("part"))
    rows = asked.join(grouped, ["dim", "part"]).select("qblock", "dim", "ids", "codes", "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                qblock, dim, ids, codes, near = (batch.column(n)[row].as_py() for n in batch.schema.names)
                ids = np.frombuffer(ids, np.int64)
                high, low = (np.concatenate([_matrix(b[side], dim) for b in near]) for side in ("high", "low"))
                reach = bounds(_matrix(codes, dim, len(ids)), high, low)
                first = reach.argmax(axis=1)
                out = []
                for j, b in enumerate(near):
                    for seed in (True, False):
                        wants = np.flatnonzero((first == j) == seed)
                        if len(wants):
                            out.append((qblock, b["block"], seed, wants, ids[wants], reach[wants, j]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.bool_(), *[pa.list_(pa.int64())] * 3))],
                    names=["qblock", "block", "seed", "wants", "query_ids", "reach"])

    return rows.mapInArrow(run, "qblock long, block long, seed boolean, wants array<long>, query_ids array<long>, reach array<long>")
