"""Hard-negative mining with STR-packed R-trees.

Vectors become integer codes. Rows are range-partitioned by label and first
coordinate, and each range is cut into groups of bounded size; inside a group
sort-tile-recursive packing over the widest coordinates orders the rows into
leaves. A group is a subtree: its boxes, leaf by leaf and level by level, hold the
least and largest code of every coordinate and label of the rows below.

A box gives an interval of inner products for each anchor: every coordinate
contributes between its two products. A best-first queue takes the boxes by their
highest bound and drops those that no anchor needs any more: outside its score
windows, strictly below its k-th best score so far, or of unfitting labels.

Two passes, each over pairs of a block of anchors and a group whose labels can
fit: the positives (same label, no window), which give each anchor its windows,
and then the negatives (other labels). A pair is a task's unit of work and holds
two blocks of bounded size; its k best rows for each window are merged by a ranking
that keeps k rows a task. Anchors are a stated subset of the rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged

#: Bytes of a group's codes at two bytes each, rows of a leaf, boxes of an inner
#: node, anchors that share a queue, groups whose list meets a block's in one task.
GROUP_BYTES, LEAF, FANOUT, ANCHORS, PART = 1 << 22, 64, 16, 1024, 1024

_GROUP = "block long, dim int, low_label long, high_label long, ids binary, labels binary, leaves binary, codes binary"
_FOUND = "block long, pos int, slot int, anchor_id long, vec_id long, score long"


def codes_of(df: DataFrame, id_col: str, label_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, label, dim, codes): floor(scale * x) of every component, as doubles that
    hold integers; rows without id, label or finite vector left out."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double") * F.lit(float(scale)))
    finite = F.forall(x, lambda v: F.coalesce((v == v) & (F.abs(v) < float("inf")), F.lit(False)))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.when(finite, x).alias("x"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    whole = F.transform("x", lambda v: F.when(F.abs(v) < float(1 << 53), F.floor(v).cast("double")).otherwise(v))
    return rows.select("id", "label", F.size("x").alias("dim"), whole.alias("codes"))


def packed(codes: np.ndarray) -> bytes:
    """A code matrix in 2 bytes each where they fit, after a byte that says so."""
    small = not codes.size or np.abs(codes).max() < 1 << 15
    return (b"h" + codes.astype(np.int16).tobytes()) if small else b"d" + codes.astype(np.float64).tobytes()


def unpacked(data: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, np.dtype(chr(data[0])), offset=1).reshape(rows, dim)


def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices in a type whose products are exact: floats while these stay
    below the mantissa, else Python integers."""
    def top(m: np.ndarray) -> int:
        return int(max(m.max(initial=0), -(m.min(initial=0))))

    most = top(a) * top(b) * max(a.shape[1], 1)
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object
    if kind is object:
        return tuple(np.array([int(v) for v in m.ravel()], object).reshape(m.shape) for m in (a, b))
    return a.astype(kind), b.astype(kind)


def tiled(codes: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows, starts of the leaves) by sort-tile-recursive packing:
    slabs of whole leaves along the widest coordinate, each cut along the next."""
    spread = codes.max(axis=0).astype(float) - codes.min(axis=0) if codes.size else np.zeros(0)
    axes = np.argsort(-spread, kind="stable")
    order, starts, done = [], [], 0
    stack = [(np.arange(len(codes)), 0)]
    while stack:
        rows, depth = stack.pop()
        leaves = -(-len(rows) // leaf)
        if leaves > 1 and depth < len(axes):
            rows = rows[np.argsort(codes[rows, axes[depth]], kind="stable")]
            slabs = max(2, round(leaves ** (1 / (len(axes) - depth))))
            size = -(-leaves // slabs) * leaf
            stack += [(rows[k:k + size], depth + 1) for k in range(0, len(rows), size)][::-1]
        else:  # one leaf, or rows that no coordinate is left for
            starts += range(done, done + len(rows), leaf)
            order.append(rows)
            done += len(rows)
    return (np.concatenate(order) if order else np.zeros(0, np.int64)), np.array(starts, np.int64)


def grouped(codes: DataFrame, group_bytes: int, leaf: int) -> DataFrame:
    """Rows as groups of bounded size (one row each), packed into leaves. Equal rows
    count once. The id is part of the range key: copies of a vector spread out."""
    key = ["dim", "label", F.try_element_at("codes", F.lit(1)).alias("first"), "id"]
    rows = codes.select(*key, "codes").repartitionByRange("dim", "label", "first", "id")
    rows = rows.sortWithinPartitions("dim", "label", "first", "id", "codes").select("dim", "label", "id", "codes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[int, int, np.ndarray]] = []
        dim = 0

        def group() -> pa.RecordBatch:
            nonlocal number, held
            matrix = np.array([c for _, _, c in held], np.float64).reshape(len(held), dim)
            order, starts = tiled(matrix, leaf)
            ids, labels = (np.array([row[k] for row in held], np.int64)[order] for k in (0, 1))
            values = [number, dim, int(labels.min()), int(labels.max()), ids.tobytes(), labels.tobytes(), starts.tobytes(), packed(matrix[order])]
            number, held = number + 1, []
            return pa.RecordBatch.from_pydict(
                {name: pa.array([v], kind) for name, v, kind in zip(
                    ("block", "dim", "low_label", "high_label", "ids", "labels", "leaves", "codes"), values,
                    (pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4))})

        for batch in batches:
            column = batch.column("codes")
            flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            for k, (i, label) in enumerate(zip(batch.column("id").to_pylist(), batch.column("label").to_pylist())):
                row = flat[offsets[k]:offsets[k + 1]]
                if held and (len(row) != dim or len(held) * 2 * max(dim, 8) >= group_bytes):
                    yield group()
                elif held and held[-1][:2] == (i, label) and np.array_equal(held[-1][2], row):
                    continue
                dim = len(row)
                held.append((i, label, row))
        if held:
            yield group()

    return rows.mapInArrow(run, _GROUP)


class Tree:
    """The boxes of a group, level by level from the leaves to one root."""

    def __init__(self, codes: np.ndarray, labels: np.ndarray, starts: np.ndarray, fanout: int = FANOUT) -> None:
        self.ends = np.append(starts[1:], len(codes))
        self.starts, self.fanout, self.levels = starts, fanout, []
        boxes = [f.reduceat(v, starts) for v, f in ((codes, np.minimum), (codes, np.maximum), (labels, np.minimum), (labels, np.maximum))]
        self.levels.append(boxes)
        while len(boxes[0]) > 1:
            at = np.arange(0, len(boxes[0]), fanout)
            boxes = [f.reduceat(v, at) for v, f in zip(boxes, (np.minimum, np.maximum, np.minimum, np.maximum))]
            self.levels.append(boxes)

    def children(self, level: int, node: int) -> range:
        return range(node * self.fanout, min((node + 1) * self.fanout, len(self.levels[level - 1][0])))


def search(codes: np.ndarray, ids: np.ndarray, labels: np.ndarray, starts: np.ndarray, anchors: np.ndarray, anchor_ids: np.ndarray,
           anchor_labels: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> Iterator[tuple[int, int, int, object]]:
    """(anchor, window, row, score): of every anchor and window (column of ``low``
    and ``high``, a range of scores that includes its ends; None for no window) the
    k best rows of the anchor's label, or of the others, without the anchor's id.
    Equal scores by smaller id."""
    if not len(codes) or not len(anchors):
        return
    codes, anchors = exact(codes, anchors)
    plain = codes.dtype != object
    tree = Tree(codes, labels, starts)
    n, windows = len(anchors), 1 if low is None else low.shape[1]
    over, under = np.maximum(anchors, 0), np.minimum(anchors, 0)
    kth = np.full((n, windows), -np.inf, np.float64 if plain else object)
    if low is None:
        low, high = (np.full((n, 1), v, object if not plain else np.float64) for v in (-np.inf, np.inf))
    found: list[tuple[np.ndarray, ...]] = []  # (slot, row, score)
    size = 0

    def settle() -> None:
        """Keeps the k best of every slot, and lifts its k-th score."""
        nonlocal found, size
        slot, row, score = (np.concatenate([f[c] for f in found]) for c in range(3))
        order = np.lexsort((ids[row], -score, slot))
        slot, row, score = slot[order], row[order], score[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        found, size = [(slot[place < k], row[place < k], score[place < k])], int((place < k).sum())
        last = place == k - 1
        kth.reshape(-1)[slot[last]] = score[last]

    def asked(level: int, node: int, who: np.ndarray) -> None:
        lows, highs, low_label, high_label = (v[node] for v in tree.levels[level])
        mine = anchor_labels[who]
        fits = ((mine >= low_label) & (mine <= high_label)) if same else ~((low_label == high_label) & (mine == low_label))
        who = who[fits]
        if len(who):
            most = over[who] @ highs + under[who] @ lows
            least = over[who] @ lows + under[who] @ highs
            open_ = ((most[:, None] >= np.maximum(low[who], kth[who])) & (least[:, None] <= high[who]) & (low[who] <= high[who])).any(axis=1)
            if open_.any():
                who, most = who[open_], most[open_]
                heapq.heappush(queue, (-float(most.max()) if plain else -most.max(), level, node, who, most))

    queue: list = []
    asked(len(tree.levels) - 1, 0, np.arange(n))
    while queue:
        _, level, node, who, most = heapq.heappop(queue)
        who = who[(most[:, None] >= kth[who]).any(axis=1)]  # strictly below every k-th: dropped
        if not len(who):
            continue
        if level:
            for child in tree.children(level, node):
                asked(level - 1, child, who)
            continue
        rows = np.arange(tree.starts[node], tree.ends[node])
        scores = anchors[who] @ codes[rows].T
        fits = (labels[rows][None, :] == anchor_labels[who][:, None]) == same
        fits &= ids[rows][None, :] != anchor_ids[who][:, None]
        for w in range(windows):
            least = np.maximum(low[who, w], kth[who, w])
            at, row = np.nonzero(fits & (scores >= least[:, None]) & (scores <= high[who, w][:, None]))
            found.append((who[at] * windows + w, rows[row], scores[at, row]))
            size += len(at)
        if size > 4 * k * windows * n:
            settle()
    if found:
        settle()
        for slot, row, score in zip(*found[0]):
            yield int(slot) // windows, int(slot) % windows, int(row), int(score)


def _found(pairs: DataFrame, anchors: DataFrame, groups: DataFrame, same: bool, k: int) -> DataFrame:
    """The k best rows of every (pair of blocks, anchor, window). ``anchors`` may
    have windows: arrays of anchor positions, slots and score ranges."""
    left = pairs.select(F.xxhash64("block", "group").alias("unit"), "block", "group").join(anchors, "block")
    whole = groups.select(F.col("block").alias("of_group"), "dim", *[F.col(c).alias(f"row_{c}") for c in ("ids", "labels", "leaves", "codes")])
    right = pairs.select(F.xxhash64("block", "group").alias("of_unit"), F.col("block").alias("of_block"), F.col("group").alias("of_group"))
    right = right.join(whole, "of_group")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for a in left.to_pylist():
            for g in right.to_pylist():
                if (a["block"], a["group"]) != (g["of_block"], g["of_group"]):
                    continue  # two pairs with one hash
                a_ids, a_labels, ids, labels, starts = (np.frombuffer(v, np.int64) for v in (
                    a["ids"], a["labels"], g["row_ids"], g["row_labels"], g["row_leaves"]))
                a_codes, codes = unpacked(a["codes"], len(a_ids), g["dim"]), unpacked(g["row_codes"], len(ids), g["dim"])
                low = high = None
                if "slots" in a:
                    low, high = _windows(a["slots"], len(a_ids))
                for first in range(0, len(a_ids), ANCHORS):
                    part = slice(first, first + ANCHORS)
                    hits = search(codes, ids, labels, starts, a_codes[part], a_ids[part], a_labels[part],
                                  None if low is None else low[part], None if low is None else high[part], same, k)
                    out += [(a["block"], first + i, w, int(a_ids[first + i]), int(ids[row]), score) for i, w, row, score in hits]
        names = [field.split()[0] for field in _FOUND.split(", ")]
        return pa.table({name: pa.array([row[c] for row in out], pa.int32() if name in ("pos", "slot") else pa.int64()) for c, name in enumerate(names)})

    return left.groupBy("unit").cogroup(right.groupBy("of_unit")).applyInArrow(run, _FOUND)


def _windows(slots: list[dict], anchors: int) -> tuple[np.ndarray, np.ndarray]:
    """[anchor, slot] ranges of scores; empty ones where there is no window."""
    wide = max((s["slot"] for s in slots), default=0) + 1
    big = any(abs(s[side]) >= 1 << 53 for s in slots for side in ("low", "high"))
    low, high = (np.full((anchors, wide), v, object if big else np.float64) for v in (1, 0))
    for s in slots:
        low[s["pos"], s["slot"]], high[s["pos"], s["slot"]] = s["low"], s["high"]
    return low, high


def _pairs(anchors: DataFrame, groups: DataFrame, fits: str) -> DataFrame:
    """(block, group) of one dimension whose labels can fit."""
    parts = -(-groups.count() // PART) or 1
    listed = groups.select(F.col("block").alias("group"), "dim", F.col("low_label").alias("low"), F.col("high_label").alias("high"),
                           F.pmod(F.xxhash64("block"), F.lit(parts).cast("long")).alias("part"))
    asked = anchors.select("block", "dim", "low_label", "high_label", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"))
    return asked.join(listed, ["dim", "part"]).where(fits).select("block", "group")


def _best(found: DataFrame, key: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(df: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: float = 256,
                   anchor_every: int = 50, positives: int = 5, negatives: int = 3, low_percent: int = 50,
                   high_percent: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    Anchors are the rows whose id is divisible by ``anchor_every``; an anchor's
    positives its ``positives`` best other rows of the same label by integer inner
    product of floor(``scale`` * x), ties to the smaller id. For each of them: the
    ``negatives`` best rows of another label that score from ``low_percent`` to
    ``high_percent`` of the positive's score, both included.

    Ids and labels are integers. Defined cases: rows with a null id, label or vector
    and vectors with null components or such that are not finite (scaled) take no
    part; vectors of different lengths are not compared, empty ones score 0 with each
    other; exactly repeated rows count once, several vectors under one id are rows of
    their own, and no row with the anchor's id is its positive or negative; anchors
    with fewer positives or negatives have fewer rows; products of any size are
    exact, and a result beyond a long is an error; an empty table gives an empty
    result; other columns are not looked at."""
    codes = codes_of(df, id_col, label_col, vector_col, scale)
    groups = staged(grouped(codes, GROUP_BYTES, LEAF), "tree")
    anchors = staged(grouped(codes.where(F.pmod("id", F.lit(anchor_every)) == 0), GROUP_BYTES, LEAF), "anchors")
    asked = anchors.select("block", "ids", "labels", "codes")

    near = _pairs(anchors, groups, "low_label <= high AND low <= high_label")
    found = _best(_found(near, asked, groups, True, positives), ["block", "pos"], positives)
    low, high = (f"CAST({f} AS DECIMAL(38, 0))" for f in (f"ceil(CAST(score AS DECIMAL(30, 0)) * {low_percent} / 100)",
                                                          f"floor(CAST(score AS DECIMAL(30, 0)) * {high_percent} / 100)"))
    of = found.select("block", "pos", (F.col("rank") - 1).alias("slot"), "anchor_id", F.col("vec_id").alias("positive_id"),
                      F.col("score").alias("positive_score"), F.expr(low).cast("long").alias("low"), F.expr(high).cast("long").alias("high"))
    of = staged(of, "positives")
    slots = of.where("low <= high").groupBy("block").agg(F.collect_list(F.struct("pos", "slot", "low", "high")).alias("slots"))

    far = _pairs(anchors, groups, "NOT (low_label = high_label AND low = high AND low = low_label)")
    hits = _best(_found(far, asked.join(slots, "block"), groups, False, negatives), ["block", "pos", "slot"], negatives)
    hits = hits.select("block", "pos", "slot", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                       F.col("score").alias("negative_score"))
    return of.join(hits, ["block", "pos", "slot"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
