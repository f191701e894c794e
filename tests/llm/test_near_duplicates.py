"""Near duplicates against a brute-force comparison of all pairs."""

import random

import numpy as np
import pytest

from barlake.llm.components import components
from barlake.llm.near_duplicates import ROWS, Sketch, band_count, near_duplicates
from barlake.llm.words import WordHashes, pieces, shingles

SPACE = " \t\n\x0b\x0c\r"


def sets_of(text, n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in SPACE[1:]:
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    if not w:
        return frozenset()
    n = min(n, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def brute(rows, n, percent):
    sets = [sets_of(t, n) for _, t in rows]
    label = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    low = min(label[a], label[b])
                    changed |= (label[a], label[b]) != (low, low)
                    label[a] = label[b] = low
    return sorted((i, len(s), c, c == i) for (i, _), s, c in zip(rows, sets, label))


def corpus(seed, groups=12, copies=9):
    """Groups of edited copies whose similarities straddle the threshold."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([4, 20, 120, 300]))]
        for _ in range(rnd.randint(1, copies)):
            w = list(base)
            for _ in range(int(len(w) * rnd.choice([0, 0.01, 0.02, 0.03, 0.06]))):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            texts.append(" ".join(w))
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,words,percent", [(1, 3, 85), (2, 5, 80), (3, 1, 90)])
def test_equals_brute_force(spark, seed, words, percent):
    rows = corpus(seed)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), words=words, percent=percent)
    assert sorted(map(tuple, got.drop("text_hash").collect())) == brute(rows, words, percent)


def test_chain_needs_no_common_centre(spark):
    """Each text is close to the next only; the smallest is close to one."""
    words = [f"t{i}" for i in range(230)]
    rows = [(i, " ".join(words[6 * k:6 * k + 100])) for i, k in enumerate([0, 5, 2, 4, 1, 3, 20, 19])]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85)
    assert sorted(map(tuple, got.drop("text_hash").collect())) == brute(rows, 3, 85)


def test_nulls_empty_short_repeated_and_extra_columns(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n ", "x"), (4, "One two", "x"), (5, "one TWO", "x"), (5, "one TWO", "x"),
            (None, "one two", "x"), (6, "one two", "x"), (7, "É é", "x"), (8, "é É", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(map(tuple, near_duplicates(docs, words=3, percent=85).drop("text_hash").collect()), key=str)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (5, 1, 4, False),
                          (None, 1, None, True), (6, 1, 6, True), (7, 1, 7, True), (8, 1, 8, True)], key=str)


def test_empty_table(spark):
    got = near_duplicates(spark.createDataFrame([], "doc_id long, text string"))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept", "text_hash"] and got.count() == 0


def test_large_group_of_copies_and_near_copies(spark):
    base = [f"b{i}" for i in range(150)]
    rows = [(i, " ".join(base)) for i in range(300)]
    rows += [(1000 + i, " ".join(base[:i % 140] + [f"x{i}"] + base[i % 140 + 1:])) for i in range(400)]
    got = {r.doc_id: r for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == 700 and {r.component_id for r in got.values()} == {0} and [r.doc_id for r in got.values() if r.kept] == [0]


def test_one_large_loose_group_is_joined_without_pairing_its_members(spark, monkeypatch):
    """Copies of one text whose similarities lie around the threshold: stars alone
    do not settle it, yet few of the 3,160 pairs are compared."""
    from barlake.llm import near_duplicates as module

    rnd, base, compared = random.Random(9), [f"b{i}" for i in range(200)], []
    rows = []
    for i in range(80):
        w = list(base)
        for _ in range(rnd.choice([1, 3, 6, 9, 14])):
            w[rnd.randrange(200)] = f"x{i}_{rnd.randrange(99)}"
        rows.append((i, " ".join(w)))
    real = module._compared
    monkeypatch.setattr(module, "_compared", lambda pairs, *a: compared.append(pairs.count()) or real(pairs, *a))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85)
    assert sorted(map(tuple, got.drop("text_hash").collect())) == brute(rows, 3, 85)
    assert len(compared) > 1 and sum(compared) < 1000


def test_sketch_estimates_similarity_for_any_set_size():
    rnd, bands = np.random.default_rng(5), 40
    sketch = Sketch(bands, ROWS)
    for size in (1, 2, 7, 50, 5000):
        base = np.unique(rnd.integers(0, 1 << 63, size, dtype=np.uint64))
        assert np.array_equal(sketch.buckets(base), sketch.buckets(base))
        assert np.isin(sketch.bins_of(base), base).all()
    a = np.unique(rnd.integers(0, 1 << 63, 4000, dtype=np.uint64))
    b = np.sort(np.concatenate([a[:3600], rnd.integers(0, 1 << 63, 400, dtype=np.uint64)]))
    same = (sketch.bins_of(a) == sketch.bins_of(b)).mean()
    assert abs(same - 3600 / 4400) < 0.12


def test_band_count_meets_the_stated_miss_rate():
    for s in (0.8, 0.85):
        assert (1 - s ** ROWS) ** band_count(s) <= 1e-7 < (1 - s ** ROWS) ** (band_count(s) - 1)


def test_words_are_cut_at_ascii_white_space_only():
    hashes = WordHashes()
    assert len(hashes.of("a\x0bB c\x1fd e".encode())) == 3
    assert hashes.of(b"ABC")[0] == hashes.of(b"abc")[0] != hashes.of("É".encode())[0]
    text = ("word " * 1000 + "x" * 5000 + " end " + "y" * 600_000 + " z\0 z").encode()
    assert b"".join(pieces(text, 64)) == text
    assert np.array_equal(hashes.of(text), np.concatenate([hashes.of(p) for p in pieces(text, 100)]))
    assert len(hashes.of(b"")) == len(hashes.of(None)) == len(hashes.of(b" \n")) == 0
    rnd = random.Random(4)
    words = ["".join(rnd.choices("aAbé\0_", k=rnd.choice([1, 2, 3, 63, 64, 65, 200]))) for _ in range(3000)]
    got = hashes.of(" \t".join(words).encode())
    low = [w.encode().translate(WordHashes.table) for w in words]
    assert got.tolist() == [int(hashes.word(w)) for w in low] and len(set(got.tolist())) == len(set(low))
    assert len(shingles(hashes.of(b"a b"), 3)) == 1 and len(shingles(hashes.of(b"a b c d"), 3)) == 2


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(300, 301), (301, 302), (302, 300), (400, 400)]
    rnd = random.Random(3)
    zigzag = rnd.sample(range(500, 560), 60)
    edges += list(zip(zigzag, zigzag[1:]))
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {200 + i: 100 for i in range(50)} | {100: 100} | {i: 300 for i in (300, 301, 302)}
    assert got == want | {i: 500 for i in range(500, 560)}


def test_rows_of_one_id_keep_the_links_of_each_text(spark):
    b, c = " ".join(f"b{k}" for k in range(60)), " ".join(f"c{k}" for k in range(60))
    rows = [(3, b), (3, c), (7, b + " x"), (9, c + " y"), (8, "b " + b), (3, b), (7, b + " x")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), words=3, percent=85)
    assert sorted(tuple(r)[:4] for r in got.collect()) == brute(rows, 3, 85)
    assert {r.component_id for r in got.collect()} == {3}


def test_ids_of_any_type(spark):
    t = " ".join(f"w{k}" for k in range(40))
    df = spark.createDataFrame([("b", t), ("a", t + " z"), ("c", "other words here"), (None, t)], "doc_id string, text string")
    got = {r.doc_id: (r.component_id, r.kept) for r in near_duplicates(df).collect()}
    assert got == {"b": ("a", False), "a": ("a", True), "c": ("c", True), None: (None, True)}


def test_a_shingle_in_very_many_prefixes_is_dealt_into_blocks(spark, monkeypatch):
    """Near pairs around one common beginning, with repeated rows."""
    from barlake.llm import near_duplicates as module

    monkeypatch.setattr(module, "PREFIX_BLOCK", 3)
    rnd = random.Random(11)
    rows = []
    for k in range(40):
        words = [f"common{j}" for j in range(12)] + [f"g{k % 13}w{j}" for j in range(24)]
        words[rnd.randrange(12, 36)] = f"edit{k}"
        rows.append((k, " ".join(words)))
    rows += rows[:5]
    for words, percent in ((1, 80), (3, 70)):
        got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), words=words, percent=percent)
        assert sorted(tuple(r)[:4] for r in got.collect()) == brute(rows, words, percent)
