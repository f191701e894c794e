"""Line dedup against plain Python; keep bitmaps; defined cases."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from barlake.llm import line_dedup
from barlake.llm.line_dedup import _runs, dedup_lines, keep_bitmaps

SPACE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, min_docs, min_chars, keep_first):
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda d: (d[0] is not None, d[0] or 0))
    holders, first = defaultdict(set), {}
    for doc in docs:
        for pos, line in enumerate(doc[1].split("\n")):
            holders[key_of(line)].add(doc)
            first.setdefault(key_of(line), (doc, pos))
    out = []
    for i, t in rows:
        doc = (i, t or "")
        lines = doc[1].split("\n")
        kept = [x for p, x in enumerate(lines) if len(key_of(x)) < min_chars or len(holders[key_of(x)]) < min_docs
                or keep_first and first[key_of(x)] == (doc, p)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def corpus():
    rows = [(i, "\n".join([f"own {i}", " Shared\t", "", f"third {i % 3}", "É È" if i % 2 else "é È", "shared", f"own {i}"])) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "third 1\r"), (None, "shared\nnull id"), (104, "x" * 100_000 + "\nSHARED")]
    return rows


@pytest.mark.parametrize("min_docs,min_chars,keep_first", [(10, 1, False), (2, 1, True), (3, 8, False), (2, 0, True)])
def test_equals_plain_python(spark, min_docs, min_chars, keep_first):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = dedup_lines(docs, min_docs=min_docs, min_chars=min_chars, keep_first=keep_first)
    got = [tuple(r) for r in got.select("row.doc_id", "n_lines", "n_dropped", "kept").collect()]
    assert sorted(got, key=str) == brute(rows, min_docs, min_chars, keep_first)


def test_both_routes_agree(spark, monkeypatch):
    """With room for one frequent hash all others take the sorted pass."""
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    want = sorted(map(str, dedup_lines(docs).drop("row").collect()))
    monkeypatch.setattr(line_dedup, "HOT", 1)
    assert sorted(map(str, dedup_lines(docs).drop("row").collect())) == want


def test_repeated_rows_are_one_document_and_columns_pass_through(spark):
    rows = [(1, "a\nb", "k", 7), (1, "a\nb", "k", 7), (2, "a", "k", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_hash string, pos int")
    out = dedup_lines(docs, min_docs=3, keep_first=False)
    assert sorted((r.row.doc_id, r.n_dropped, r.row.text_hash, r.row.pos) for r in out.collect()) == [
        (1, 0, "k", 7), (1, 0, "k", 7), (2, 0, "k", 8)]
    assert sorted(r.kept for r in dedup_lines(docs, min_docs=2, keep_first=False).collect()) == ["", "b", "b"]


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bitmaps_are_run_lengths(spark):
    at = spark.createDataFrame([([0, 1, 4, 6, 7, 8],), ([3],)], "at array<int>")
    assert [r[0] for r in at.select(_runs(F.col("at"))).collect()] == [[0, 2, 2, 1, 1, 3], [3, 1]]
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, "b\nx")], "doc_id long, text string")
    got = keep_bitmaps(docs, min_docs=2, keep_first=False).select("id", "n_dropped", "keep_runs").collect()
    assert sorted(map(tuple, got)) == [(1, 1, [1, 1]), (2, 1, [0, 1])]


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = dedup_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hash_of_kept_text(spark):
    docs = spark.createDataFrame([(1, "ä\nb")], "doc_id long, text string")
    got = dedup_lines(docs).select(F.sha2("kept", 256)).first()[0]
    assert got == hashlib.sha256("ä\nb".encode()).hexdigest()


def test_repeated_rows_of_the_first_document_keep_their_line_on_both_routes(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a\nb"), (1, "a\nb"), (2, "a"), (3, "z\nz\nz")], "doc_id long, text string")
    for room in (256, 1):
        monkeypatch.setattr(line_dedup, "HOT", room)
        assert sorted(r.kept for r in dedup_lines(docs).collect()) == ["", "a\nb", "a\nb", "z\nz\nz"]
