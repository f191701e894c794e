"""Importance resampling against a plain recount with zlib, and its planes."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from barlake.llm import importance as module
from barlake.llm.importance import NgramHashes, planes, resample, weigh
from barlake.llm.words import pieces as module_pieces

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, most=3):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = WORD.findall(lower)
    return len(words), [" ".join(words[i:i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def bucket(feature, buckets=10000):
    return zlib.crc32(feature.encode()) % buckets


def brute(docs, target, percent=5, buckets=10000, least=20, seed=42):
    s, t = Counter(), Counter()
    for into, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            into.update(bucket(f, buckets) for f in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for i, x in docs:
        words, found = features(x)
        weight = sum(gain[bucket(f, buckets)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for k, r in enumerate(fit[:len(fit) * percent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def got(spark, docs, target, **kw):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = resample(df.repartition(3), spark.createDataFrame([(x,) for x in target], "text string"), **kw)
    return sorted(map(tuple, out.drop("n_words").collect()), key=str)


TEXTS = ["Über den Wolken, muß die FREIHEIT wohl 99 grenzenlos sein " * 3, "a-b_c d\x00e\x7ff  g\tH\nI " * 9, "x" * 5000 + " y " + "z" * 49,
         "数据 处理 引擎" * 40, "", None, "one", "one two", "...", "k " * 500, "w" * 48 + " " + "v" * 49 + " u" * 30]


def test_equals_a_plain_recount(spark):
    rnd = np.random.default_rng(3)
    docs = list(enumerate(TEXTS)) + [(100 + i, " ".join(f"w{k}" for k in rnd.zipf(1.4, rnd.integers(1, 90)) % 300)) for i in range(300)]
    docs += [docs[3], (None, "a null id " * 20), (None, None)]
    target = [" ".join(f"w{k}" for k in rnd.zipf(1.3, 40) % 200) for _ in range(20)] + [None, ""]
    assert got(spark, docs, target, percent=20) == brute(docs, target, 20)
    assert got(spark, docs, target, percent=100, buckets=97, least_words=1) == brute(docs, target, 100, 97, 1)


def test_long_texts_are_hashed_in_pieces(spark, monkeypatch):
    hashes = NgramHashes(3)
    rnd = np.random.default_rng(5)
    texts = [" ".join("v" * int(n) for n in rnd.integers(1, 60, 400)), "a" * 3000 + " b c " + "d" * 70, "  ", "one", None, "é " * 300]
    for size in (7, 64, 1 << 18):
        monkeypatch.setattr(module, "pieces", lambda t, size=size: module_pieces(t, size))
        counts = Counter()
        for items in hashes.items(iter(t.encode() if t is not None else None for t in texts)):
            owner, found, _ = hashes.of(items)
            counts.update((items[o][0], int(h)) for o, h in zip(owner, found))
        assert counts == Counter((k, zlib.crc32(f.encode())) for k, t in enumerate(texts) for f in features(t)[1])


@pytest.mark.parametrize("most", [1, 70000, 1 << 33])
def test_planes_give_exact_products(most):
    rnd = np.random.default_rng(most)
    counts, gain = rnd.integers(0, most + 1, (5, 131)), rnd.integers(-20000, 20001, 131)
    positive, negative = (planes(np.maximum(sign * gain, 0)[None, :]) for sign in (1, -1))
    assert weigh(counts, positive, negative).tolist() == (counts @ gain).tolist()


def test_empty_tables_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([("a", "one two three " * 9, 1, 2.0)], "doc_id string, text string, score int, weight double")
    assert resample(empty, some).collect() == []
    assert [r.doc_id for r in resample(some, empty, percent=100).collect()] == ["a"]


def test_draws_what_resembles_the_target(spark):
    docs = [(i, ("alpha beta gamma " if i % 10 == 0 else "delta epsilon zeta ") * 10) for i in range(200)]
    drawn = [r.doc_id for r in resample(spark.createDataFrame(docs, "doc_id long, text string"),
                                        spark.createDataFrame([("alpha beta gamma",)], "text string"), percent=10).where("rank > 0").collect()]
    assert sorted(drawn) == [i for i in range(200) if i % 10 == 0]
