"""Personal data: base spans against Python's own regular expressions, positions in
code points, and what the boosted trees add."""

import random
import re
import time

import pytest

from barlake.llm import personal_data as module
from barlake.llm.boosting import fit, threshold
from barlake.llm.personal_data import FEATURES, KINDS, Detector, _running, personal_data, spelled, train

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def good(kind, span):
    digits = re.sub("[^0-9]", "", span)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in span.split(".")),
            "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def brute(text):
    found = [(m.start(), n, m.end(), kind) for n, kind in enumerate(KINDS) for m in re.finditer(PATTERNS[kind], text or "") if good(kind, m[0])]
    return sorted(found)


def base(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: [tuple(s) for s in r.base] for r in personal_data(df, Detector({})).collect()}


PIECES = ["a@b.c", "x@y.com_z@w.org", "me.you%+-_1@mail-1.example.co.uk", "@", ".", "..", "a@b", "ab@ c.d", "192.168.0.1", "256.1.1.1", "1.2.3.4.5.6.7.8",
          "000255.0.00.1", "99999999999999999999.1.1.1", "4539 1488 0343 6467", "4539-1488-0343-6467", "4539148803436467", "4539148803436468", "0" * 12, "1 2",
          "+1 (171) 555-2028", "+1", "+12", "+1((((((", "+44 20 7946 0958.", "+123456789012345678", " ", "  ", "\n", "é", "😀", "日本", "-", "7", "٣", "x", "￼", "a.b-c_d"]


def test_base_spans_equal_plain_regular_expressions(spark):
    rnd = random.Random(4)
    texts = ["".join(rnd.choices(PIECES, k=rnd.randint(1, 25))) for _ in range(1500)] + [None, "", "a" * 2000, "a." * 1000 + "@", "1" * 2000,
             "1." * 6000, "+1" + " " * 2000, "a@" + "b." * 5000, "q@r.st " * 4000, "(" * 1000]
    got = base(spark, texts)
    for k, text in enumerate(texts):
        assert got[k] == brute(text), text[:300]


def test_long_runs_take_linear_time(spark):
    runs = ["a" * 400_000, "a." * 200_000 + "@", "1" * 400_000, "1." * 200_000, "+1" + " " * 400_000, "a@" + "b." * 200_000, "a at " * 80_000, "[dot]" * 80_000]
    detector = train(spark.createDataFrame(corpus()[:200], "doc_id long, text string"))
    df = spark.createDataFrame(list(enumerate(runs)), "doc_id long, text string").repartition(8)
    at = time.monotonic()
    assert {r.doc_id: len(r.base) for r in personal_data(df, detector).collect()} == {0: 0, 1: 0, 2: 0, 3: 50_000, 4: 0, 5: 1, 6: 0, 7: 0}
    assert time.monotonic() - at < 60


def test_running_sums_in_blocks(spark, monkeypatch):
    for block, n in ((2, 7), (3, 9), (512, 1300), (4, 1)):
        monkeypatch.setattr(module, "BLOCK", block)
        got = spark.range(1).selectExpr(f"transform(sequence(1, {n}), x -> CAST(x AS BIGINT)) AS w").selectExpr(f"{_running('w')} AS c").first().c
        assert got == [k * (k + 1) // 2 for k in range(1, n + 1)]


def corpus():
    rnd = random.Random(9)

    def card():
        body = "4" + "".join(rnd.choices("0123456789", k=14))
        return next(body + d for d in "0123456789" if luhn(body + d))

    docs = []
    for k in range(600):
        words = " ".join(rnd.choices("the of and to in reads that was for".split(), k=30))
        plain = [f"{rnd.choice('abcdef')}{k}.{rnd.randint(10, 99)}@mail{k % 7}.example.com", ".".join(str(rnd.randint(0, 255)) for _ in range(4)), card(),
                 f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}", f"{rnd.randint(10**15, 10**16 - 1)}", f"version {k}.{k}", f"{k} at noon. {k} dot"]
        docs.append((k, f"{words} {plain[k % len(plain)]} {words}"))
    return docs


ADDED = [("email", "write to jane.doe at mail3 dot example dot com today", "jane.doe at mail3 dot example dot com"),
         ("email", "of a.12 [at] mail6 [dot] example [dot] com the", "a.12 [at] mail6 [dot] example [dot] com"),
         ("ip", "from 10[.]20[.]30[.]40 in", "10[.]20[.]30[.]40"), ("card", "of 4539148803436467 4539148803436467 the", "4539148803436467"),
         ("phone", "that (555) 555-2028 was", "(555) 555-2028")]


def test_the_trees_add_what_the_base_misses_and_leave_clean_text_alone(spark):
    detector = train(spark.createDataFrame(corpus(), "doc_id long, text string"))
    assert set(detector.models) == set(KINDS)
    clean = ["we met at noon. the dot was red at the end. of 12 at 5", "1234567890123456 1234567890123456", "v 1.2.3 and 4,5,6,7", "300[.]20[.]30[.]40",
             "on 2024-01-02 or 12 345 6789 of", "", None]
    df = spark.createDataFrame(list(enumerate([t for _, t, _ in ADDED] + clean)), "doc_id long, text string")
    found = {r.doc_id: r for r in personal_data(df, detector).collect()}
    for k, (kind, text, span) in enumerate(ADDED):
        assert (kind, span) in [(s.name, text[s.start:s.stop]) for s in found[k].added], (kind, text, found[k])
    assert {t: (found[k].added, found[k].base) for k, t in enumerate(clean, len(ADDED)) if found[k].added or found[k].base} == {}


def test_no_examples_no_additions_and_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert train(empty).models == {} and personal_data(empty, Detector({})).collect() == []
    df = spark.createDataFrame([("k", "mail a@b.c", 1, 2), (None, "+1 555 555 5555 é a@b.c", 3, 4), (None, None, 5, 6)], "doc_id string, text string, base int, rest int")
    out = personal_data(df, train(df)).select("doc_id", spelled("base").alias("s")).collect()
    assert sorted(map(str, out)) == sorted(["Row(doc_id='k', s='email:5:10')", "Row(doc_id=None, s='phone:0:15,email:18:23')", "Row(doc_id=None, s='')"])


def test_column_expression_equals_the_trees(spark):
    rnd = random.Random(2)
    rows = [{n: rnd.randint(0, 5) for n in FEATURES} for _ in range(300)]
    for r in rows:
        r["yes"], r["no"] = (1.0, 0.0) if r["form"] > 2 and r["digits"] < 4 else (0.0, 1.0)
    model = fit(rows, FEATURES)
    df = spark.createDataFrame(rows).selectExpr("*", f"{model.sql('')} AS score")
    for r in df.collect():
        assert r.score == pytest.approx(model.of(r.asDict()), abs=1e-6)
        assert (r.score > 0) == bool(r.yes)


def test_threshold_is_the_lowest_with_the_precision():
    assert threshold([3, 2, 1], [50, 50, 0], [0, 0, 60], 0.9, 1) == 2
    assert threshold([3, 2, 1], [1, 0, 0], [0, 9, 9], 0.9, 1) is None


def test_query_counts_the_base_and_lists_all_spans(spark):
    import hashlib

    from barlake.llm.bindings import op11_personal_data

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op11_personal_data(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r.doc_id])
        listed = [f"{kind}:{start}:{stop}" for start, _, stop, kind in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(kind == k for *_, kind in base) for k in KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(listed) <= set(spans) and len(spans) == len(listed) + r.n_added
