"""Decontamination against a plain dynamic-programming alignment of all pairs."""

import random
import re

import numpy as np
import pytest

from barlake.llm.decontamination import Words, align, bitmap, leaks, passing


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def score(a, b):
    """Best local alignment, cell by cell."""
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (1 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        row = new
        best = max(best, *row)
    return best


def edited(words, rate, rnd):
    out = []
    for w in words:
        r = rnd.random()
        if r < rate / 3:
            continue
        out.append(f"new{rnd.randrange(999)}" if r < 2 * rate / 3 else w)
        if 2 * rate / 3 <= r < rate:
            out.append(f"more{rnd.randrange(999)}")
    return out


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(300)] + ["the", "of", "and", "a"] * 20
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(12, 60))).capitalize() + ".") for i in range(15)]
    docs = []
    for d in range(120):
        body = rnd.choices(vocabulary, k=rnd.randint(0, 400))
        if d % 2:
            at = rnd.randint(0, len(body))
            body[at:at] = edited(words_of(items[d % 15][1]), rnd.choice([0, 0.1, 0.2, 0.3, 0.6]), rnd)
        docs.append((d, ", ".join(body)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_finds_what_a_full_alignment_finds(spark, seed):
    docs, items = corpus(seed)
    want = {(d, i): score(words_of(t), words_of(text)) / len(words_of(t)) for d, text in docs for i, t in items}
    got = leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.id, r.item): r for r in got.collect()}
    assert set(got) == {k for k, v in want.items() if v >= 0.5} and len(got) > 30
    for (d, i), r in got.items():
        assert r.score == pytest.approx(want[d, i])
        place = words_of(docs[d][1])[r.start:r.stop]
        assert score(words_of(items[i][1]), place) / len(words_of(items[i][1])) == pytest.approx(r.score)


def test_an_item_that_a_third_of_all_documents_hold(spark):
    item = " ".join(f"q{k}" for k in range(30))
    docs = [(d, f"start {d} {item if d % 3 == 0 else ''} end w{d}") for d in range(600)]
    items = spark.createDataFrame([(1, item), (2, "start end other words")], "item_id long, text string")
    got = leaks(spark.createDataFrame(docs, "doc_id long, text string"), items)
    assert sorted((r.id, r.item) for r in got.collect()) == [(d, 1) for d in range(0, 600, 3)]


def test_nulls_short_long_repeated_and_empty(spark):
    item = "alpha beta gamma delta epsilon zeta"
    docs = [(None, item), (1, None), (2, ""), (3, "alpha beta"), (4, item), (4, item), (5, "x " * 60_000 + item.upper() + "!" + " y" * 60_000)]
    docs = spark.createDataFrame([(i, t, 9) for i, t in docs], "doc_id long, text string, item int")
    items = spark.createDataFrame([(7, item), (7, item), (8, None), (9, "alpha beta"), (None, item), (10, "")], "item_id long, text string")
    got = sorted(((r.id, r.item, r.score, r.start, r.stop) for r in leaks(docs, items).collect()), key=str)
    assert got == sorted([(None, 7, 1.0, 0, 6), (4, 7, 1.0, 0, 6), (5, 7, 1.0, 60_000, 60_006)], key=str)
    assert leaks(docs.limit(0), items).count() == 0 and leaks(docs, items.limit(0)).count() == 0


def test_alignment_places():
    a = np.arange(10, dtype=np.int64)
    b = np.concatenate([np.full(5, 99), a[:4], [77], a[4:], np.full(3, 98)])
    assert align(a, b) == (9, 5, 16) and align(a, np.full(4, 50)) == (0, 0, 0)


def test_bitmap_has_every_hash(spark):
    rnd = np.random.default_rng(1)
    h = rnd.integers(-(1 << 63), 1 << 63, 5000, dtype=np.int64)
    bits = bitmap(spark.createDataFrame([(int(x),) for x in h], "h long")).value
    assert passing(bits, h.view(np.uint64)).all()
    assert passing(bits, rnd.integers(0, 1 << 63, 5000, dtype=np.uint64)).mean() < 0.1


def test_words_ignore_case_and_ascii_punctuation():
    w = Words()
    assert w.of("Éa, (B-c)".encode()).tolist() == w.of("éA b\nC".encode()).tolist()


def test_query_and_stage_find_parts_and_edited_copies_of_long_items(spark, tmp_root):
    import corpus_pipeline as cp
    from barlake.llm.bindings import op4_benchmark_decontamination

    item = [f"q{k}" for k in range(59)]
    replaced = [f"new{k}" if k % 10 in (5, 7, 9) else w for k, w in enumerate(item)]
    texts = [item, item[:29], item[20:30], replaced, item[:9], ["x"] * 30]
    around = " ".join(f"z{k}" for k in range(50))
    rows = [(d, f"{around} {' '.join(t)} {around}") for d, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_root}/documents.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_root}/benchmark.parquet")
    got = {r.doc_id: r.score for r in op4_benchmark_decontamination(spark, tmp_root).collect()}
    assert set(got) == {0, 1, 2, 3} and got[1] == pytest.approx(29 / 59) and got[3] < 0.5
    left = cp.by_benchmark(spark, spark.read.parquet(f"{tmp_root}/documents.parquet"), tmp_root)
    assert sorted(r.doc_id for r in left.collect()) == [4, 5]
