"""Exact top-k against plain numpy, with ties, pruning and odd vectors."""

import numpy as np
import pytest

from barlake.llm import exact_top_k as module
from barlake.llm.exact_top_k import bounds, exact_top_k, products


def brute(rows, k, every):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good[i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)] = 1
    out = []
    for q, a in good:
        if q % every == 0:
            hits = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(hits)]
    return sorted(out)


def data(n, dim, seed):
    rnd = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in v]) for i, v in zip(rnd.permutation(n), rnd.normal(0, 0.2, (n, dim)).astype(np.float32))]


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_equals_numpy_in_any_blocking(spark, monkeypatch, block):
    monkeypatch.setattr(module, "DOC_BLOCK", block)
    monkeypatch.setattr(module, "QUERY_BLOCK", 3)
    monkeypatch.setattr(module, "GROUP", 5)
    rows = data(400, 9, 1) + [(1000 + i, [0.25] * 9) for i in range(60)]
    got = exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4), k=5, query_every=20)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 20)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (50, [float("inf"), 1.0]),
            (100, [0.5]), (101, [0.25]), (150, []), (None, [1.0, 1.0]), (1, [1.0, 2.0]), (5, [3e4, -3e4]), (200, [-1e6, 1.0])]
    got = exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 50)
    assert exact_top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_bounds_hold_and_prune():
    rnd = np.random.default_rng(2)
    q, d = rnd.integers(-90, 90, (20, 16)), rnd.integers(-90, 90, (500, 16))
    reach = bounds(q, d.max(axis=0)[None], d.min(axis=0)[None])
    assert (products(q, d) <= reach).all()
    near = np.abs(q[:1]) * np.sign(q[:1])
    assert bounds(q[:1], near, near)[0, 0] == int((q[0] * q[0]).sum())


def test_products_are_exact_for_large_codes():
    a, b = np.array([[1 << 20, 3, -5]]), np.array([[1 << 20, 7, 11], [1 << 30, 1, 1]])
    assert products(a, b).tolist() == [[(1 << 40) + 21 - 55, (1 << 50) + 3 - 5]]
    assert products(np.array([[1 << 31]]), np.array([[(1 << 31) - 1]]))[0, 0] == (1 << 31) * ((1 << 31) - 1)
