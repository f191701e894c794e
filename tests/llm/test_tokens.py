"""Token counts and packing against the tokenizer library."""

import zlib
from collections import defaultdict
from functools import lru_cache

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barlake.llm import token_counts as module
from barlake.llm.packing import Encoder, cuts, pack
from barlake.llm.token_counts import Counter, chunk_map, compose, count, scan, token_counts

SF001 = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = ["", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|> <| endoftext|>", "don't I'll 've ''s 're''re 'tis '' 'S 'RE",
        "\x1c\x1d a\x1fb", "ΑΣ ΟΔΟΣ Σ", "İstanbul ǅ Ǆ ſ K Å ẞ ß ﬁ", "é e\u0301 \u0301", "a\u00a0b c\x85d\u2003e\u200bf", "１２３ ½ ² ٣ 4 55",
        "🙂🙂🏽 👩‍👩‍👧", "日本語テキスト", "x" * 3000, "'" * 300, "\ufeff", " \n\t ", "aaaa" * 40 + " " + "=-" * 100]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return Counter(open(PATH, encoding="utf-8").read())


def texts():
    return [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF001}/documents.parquet'").fetchall()] + HARD


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_the_librarys(library, counter):
    want = [len(x) for x in ids_of(library, texts())]
    for size in (5, 64, 1 << 18):
        assert [count(counter, t.encode(), size) for t in (texts() if size > 5 else HARD)] == (want if size > 5 else want[-len(HARD):])


@lru_cache
def both():
    return Tokenizer.from_file(PATH), Counter(open(PATH, encoding="utf-8").read())


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n'stremlvdABCéß<|>"))), st.integers(1, 9))
def test_counts_of_any_text(text, size):
    library, counter = both()
    assert count(counter, text.encode(), size) == len(library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 48_000), st.integers(0, 48_000))
def test_tokens_stay_apart_as_plain_merging_says(i, j):
    words = both()[1].words
    names = list(words.made)
    a, b = names[i], names[j]
    assert words.merged(a) == [a] or not words._fits("", a)
    if words.merged(a) == [a] and words.merged(b) == [b]:
        assert words.stay_apart(a, b, len(words.ranks)) == (words.merged(a + b) == [a, b])


def test_caches_may_be_emptied(library, monkeypatch):
    monkeypatch.setattr(module, "CACHE_WORDS", 10)
    monkeypatch.setattr(module, "CACHE_STATES", 50)
    counter = Counter(open(PATH, encoding="utf-8").read())
    some = texts()[:40]
    assert [count(counter, t.encode()) for t in some] == [len(x) for x in ids_of(library, some)]


def test_maps_compose_in_any_order(counter):
    maps = [chunk_map(counter, c) for c in (b"ab", b"c d", b"", b" e f", b"gh", b"i ")]
    left = maps[0]
    for m in maps[1:]:
        left = compose(counter, left, m)
    right = maps[-1]
    for m in reversed(maps[:-1]):
        right = compose(counter, m, right)
    assert left == right == scan(counter, maps)[-1]
    one = scan(counter, maps[:4])
    assert one == scan(counter, maps)[:4]


def test_token_counts_rows(spark, library):
    rows = list(enumerate(texts())) + [(None, "a b"), (7, None), (7, None)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_tokens int").repartition(3)
    ids = ids_of(library, [t or "" for _, t in rows])
    want = [(i, len((t or "").encode()), len(x), len(x) > 2048) for (i, t), x in zip(rows, ids)]
    assert sorted(map(tuple, token_counts(docs, PATH).collect()), key=str) == sorted(want, key=str)
    assert token_counts(docs.limit(0), PATH).count() == 0


def test_encoder_gives_the_librarys_ids(library):
    encoder = Encoder(open(PATH, encoding="utf-8").read(), 2)
    for text, ids in zip(texts(), ids_of(library, texts())):
        assert np.frombuffer(encoder.ids(text.encode()), "<u4").tolist() == [*ids, 2]


def test_packing_covers_every_token_once(spark, library):
    rows = list(enumerate(texts())) + [(900, None), (901, " ".join(["word"] * 9000))]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, offset int").repartition(3)
    pieces = pack(docs, PATH, capacity=4096).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for (i, _), ids in zip(rows, ids_of(library, [t or "" for _, t in rows])):
        data, at = np.array([*ids, 2], "<u4"), 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(data), zlib.crc32(data[at:at + p.length].tobytes()))
            at += p.length
        assert at == len(data)
    for sequence in by_sequence.values():
        at = 0
        for p in sorted(sequence, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096 and at & (at - 1) == 0
        assert len({p.length for p in sequence}) == 1 and len(sequence) * sequence[0].length == at
    full = sum(len(s) * s[0].length == 4096 for s in by_sequence.values())
    assert full >= len(by_sequence) - 3 * 12 * 12


def test_packing_rejects_odd_capacities_and_takes_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack(docs, PATH).count() == 0
    with pytest.raises(ValueError):
        pack(docs, PATH, capacity=1000)
    assert list(cuts(4096 * 2 + 5, 4096)) == [(0, 4096), (4096, 4096), (8192, 4), (8196, 1)] and list(cuts(0, 8)) == []
