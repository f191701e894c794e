"""Patience alignment and license notices in edited texts."""

import random

from hypothesis import given
from hypothesis import strategies as st

from barlake.llm.licenses import TEMPLATES, Scanner, aligned, increasing, license_scan


def longest(values):
    best = [1] * len(values)
    for k, v in enumerate(values):
        best[k] = 1 + max((best[j] for j in range(k) if values[j] < v), default=0)
    return max(best, default=0)


@given(st.lists(st.integers(0, 20), max_size=40))
def test_increasing_is_longest(values):
    got = increasing(values)
    assert len(got) == longest(values) and got == sorted(got)
    assert all(values[a] < values[b] for a, b in zip(got, got[1:]))


@given(st.lists(st.integers(0, 6), max_size=30), st.lists(st.integers(0, 6), max_size=30))
def test_alignment_is_increasing_and_true(a, b):
    got = aligned(a, b)
    assert all(a[i] == b[j] for i, j in got)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
    assert aligned(a, a) == [(k, k) for k in range(len(a))]


def test_every_notice_is_found_where_it_stands(spark):
    rnd = random.Random(2)
    filler = [f"w{k}" for k in range(500)] + ["the", "of", "license", "software", "and", "is", "a"] * 30
    docs, want = [], set()
    for n, (name, notice) in enumerate(TEMPLATES.items()):
        for copy in range(3):
            before = rnd.choices(filler, k=rnd.randint(0, 300))
            words = notice.split()
            for _ in range(copy and len(words) // 12):
                words[rnd.randrange(len(words))] = "changed"
            key = n * 10 + copy
            docs.append((key, " ".join([*before, *words, *rnd.choices(filler, k=50)])))
            want.add((key, name))
    docs += [(900, " ".join(rnd.choices(filler, k=5000))), (901, None), (902, ""), (903, "license")]
    got = license_scan(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    found = {(r.doc_id, r.license) for r in got}
    assert want <= found and not {d for d, _ in found} & {900, 901, 902, 903}
    # a longer notice may hold a shorter one's words
    assert {(d, n) for d, n in found - want} <= {(d, "apache-2.0") for d, n in want if n == "apache-2.0-header"}


def test_repeated_notices_ids_and_empty_tables(spark):
    text = "MIT. Released under the MIT License. Released under\nthe MIT license! x released under a MIT License"
    docs = spark.createDataFrame([(1, text, "q"), (None, text, "q"), (1, text, "q")], "doc_id long, text string, license string")
    got = [(r.doc_id, r.license, round(r.coverage, 1), r.start, r.stop) for r in license_scan(docs).collect()]
    one = [(1, "mit", 1.0, 1, 6), (1, "mit", 1.0, 6, 11), (1, "mit", 0.8, 12, 17)]
    assert sorted(got, key=str) == sorted(one * 2 + [(None, *r[1:]) for r in one], key=str)
    assert license_scan(docs.limit(0)).count() == 0 and license_scan(docs, {}).count() == 0


def test_scanner_has_no_length_limit():
    scanner = Scanner(TEMPLATES, 0.8)
    assert len(scanner.known) > 100
