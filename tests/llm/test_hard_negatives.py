"""Hard negatives against plain integer arithmetic, in any blocking."""

import numpy as np
import pytest

from barlake.llm import hard_negatives as module
from barlake.llm.hard_negatives import Tree, hard_negatives, search, tiled

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, every=50, positives=5, negatives=3):
    good = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good[i, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)] = 1
    out = []
    for q, mine, a in good:
        if q % every:
            continue
        scored = [(sum(x * y for x, y in zip(a, b)), i, label) for i, label, b in good if i != q and len(a) == len(b)]
        for score, i in sorted(((s, i) for s, i, label in scored if label == mine), key=lambda r: (-r[0], r[1]))[:positives]:
            fit = sorted(((s, j) for s, j, label in scored if label != mine and 50 * score <= 100 * s <= 95 * score), key=lambda r: (-r[0], r[1]))
            out += [(q, i, n + 1, j, score, s) for n, (s, j) in enumerate(fit[:negatives])]
    return sorted(out)


def got(spark, rows, **kw):
    return sorted(map(tuple, hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(4), **kw).collect()))


def data(n, dim, labels, seed, clusters=4):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, 0.3, (clusters, dim))
    vectors = (centres[rnd.integers(0, clusters, n)] + rnd.normal(0, 0.15, (n, dim))).astype(np.float32)
    return [(int(i), int(label), [float(x) for x in v]) for i, label, v in zip(rnd.permutation(n), rnd.integers(0, labels, n), vectors)]


@pytest.mark.parametrize("group, leaf, anchors", [(16 * 9, 2, 3), (1 << 12, 8, 1024)])
def test_equals_plain_arithmetic_in_any_blocking(spark, monkeypatch, group, leaf, anchors):
    for name, value in (("GROUP_BYTES", group), ("LEAF", leaf), ("ANCHORS", anchors), ("PART", 3)):
        monkeypatch.setattr(module, name, value)
    rows = data(300, 6, 3, 1) + [(1000 + i, i % 2, [0.25] * 6) for i in range(80)]
    assert got(spark, rows, anchor_every=20) == brute(rows, 20)


def test_odd_rows(spark):
    rows = [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0]), (2, 2, None), (3, 2, [1.0, None]), (4, 2, [float("nan"), 1.0]),
            (50, 1, [float("inf"), 1.0]), (100, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (5, 2, [0.5, 1.0]), (6, 3, [0.6, 1.2]),
            (7, 3, [0.6, 1.2]), (150, 1, []), (151, 1, []), (152, 2, []), (200, 1, [-1.0, 2.0]), (1, 2, [0.7, 1.3]), (250, 9, [0.5]),
            (300, 1, [-1.0, -1.0])]
    assert got(spark, rows) == brute(rows) != []


def test_products_of_any_size_are_exact(spark):
    rows = [(0, 1, [3e6, 1.0]), (1, 1, [3e6, 2.0])] + [(10 + k, 2, [2.5e6, float(k)]) for k in range(8)]
    assert got(spark, rows) == brute(rows) != []
    rows = [(0, 1, [1e30, 1.0]), (1, 1, [-1e30, 2.0]), (2, 1, [1e-2, 0.5]), (3, 2, [1e-2, 0.25])]
    with pytest.raises(Exception):
        got(spark, rows)


def test_empty_table_and_other_columns(spark):
    assert got(spark, []) == []
    df = spark.createDataFrame([(0, 1, [1.0], 5, "x"), (1, 1, [1.0], 6, "y"), (2, 0, [0.75], 7, "z")],
                               "vec_id int, label long, embedding array<double>, rank int, dim string")
    assert [tuple(r) for r in hard_negatives(df).collect()] == [(0, 1, 1, 2, 65536, 49152)]


def test_boxes_hold_their_rows_and_the_queue_prunes():
    rnd = np.random.default_rng(2)
    codes = (rnd.normal(0, 20, (4000, 3)) + 300 * rnd.integers(-3, 4, (4000, 3))).round()
    order, starts = tiled(codes, 16)
    assert sorted(order) == list(range(4000)) and starts[0] == 0 and np.diff(np.append(starts, 4000)).max() <= 16
    tree = Tree(codes[order], np.zeros(4000, np.int64), starts)
    for (low, high, *_), (above_low, above_high, *_) in zip(tree.levels, tree.levels[1:]):
        for node in range(len(above_low)):
            below = slice(node * tree.fanout, (node + 1) * tree.fanout)
            assert (low[below] >= above_low[node]).all() and (high[below] <= above_high[node]).all()
    seen = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.dtype == np.int64 and key.ndim == 1:
                seen.append(len(key))
            return super().__getitem__(key)

    anchor = np.array([[700.0, 700.0, 700.0]])
    ids = order.astype(np.int64)
    hits = [*search(codes[order], ids, np.zeros(4000, np.int64).view(Counting), starts, anchor, np.array([-1]), np.zeros(1, np.int64), None, None, True, 3)]
    best = sorted((-int(s), int(i)) for i, s in enumerate(codes @ anchor[0]))[:3]
    assert [(-s, int(ids[row])) for _, _, row, s in hits] == best
    assert sum(seen) < 1000  # of 4000 rows
