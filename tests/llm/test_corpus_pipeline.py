"""The pipeline, stage by stage, on planted cases and on the small tables."""

import corpus_pipeline as cp
import pytest

SF = "/root/testdata/sf0.001"


def words(prefix, n):
    return " ".join(f"{prefix}{k}" for k in range(n))


@pytest.fixture()
def folder(spark, tmp_root):
    shared = "the footer that all of these documents have in common"
    text = ["the of and to in is that it was for on are as with his they " + words(f"d{i}x", 60) for i in range(30)]
    rows = [(i, "\n".join([t, shared, *(words(f'e{i}y{k}', 12) for k in range(3))]), "en", "s", len(t)) for i, t in enumerate(text)]
    rows += [(100 + i, f"the of and {words('copy', 80)}\nin is that {words('z', 80)}", "en", "s", 1) for i in range(15)]   # copies
    rows += [(200, f"the of and {words('copy', 78)} changed here\nin is that {words('z', 80)}", "en", "s", 1)]               # a near copy
    rows += [(300, f"the of and {words('own', 50)} {words('item', 25)} to in is {words('rest', 50)}", "en", "s", 1)]          # a leak
    rows += [(400, "Это другой язык " * 30, None, "s", 1), (401, None, None, None, None), (402, "", "en", "s", 0), (0, rows[0][1], "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_root}/documents.parquet")
    spark.createDataFrame([(1, words("item", 25))], "item_id long, text string").write.parquet(f"{tmp_root}/benchmark.parquet")
    return tmp_root, shared


def test_every_stage_takes_effect_on_planted_cases(spark, folder):
    path, shared = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in cp.STAGES[:-1]:
        docs = cp.staged(stage(spark, docs, path), name)
        assert docs.columns == columns
        seen[name] = docs.collect()
    clean = set(range(30))
    ids = {name: [r.doc_id for r in rows] for name, rows in seen.items()}
    assert set(ids["language_id"]) == clean | set(range(100, 115)) | {200, 300}
    assert sorted(ids["line_dedup"]) == sorted(ids["language_id"])
    assert sum(shared in r.text for r in seen["line_dedup"]) == 2  # the first document, which is there twice
    assert all(r.n_chars == len(r.text) for r in seen["line_dedup"] if 0 < r.doc_id < 30)
    assert [r.text for r in seen["line_dedup"] if r.doc_id == 107] == [r.text for r in seen["language_id"] if r.doc_id == 107]
    assert sorted(ids["near_duplicates"]) == sorted(clean | {100, 300})
    assert sorted(ids["decontamination"]) == sorted(clean | {100})
    pieces = cp.run(spark, path).collect()
    assert {p.doc_id for p in pieces} == clean | {100}


def test_near_duplicate_stage_keeps_one_of_repeated_rows_and_all_null_ids(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, words("a", 30)), (1, words("a", 30)), (2, words("a", 30)), (3, words("b", 30)), (3, words("c", 30)), (None, words("q", 9)), (4, "")]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], kind)
    got = sorted(((r.doc_id, r.text) for r in cp.by_near_duplicate(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, words("a", 30)), (3, words("b", 30)), (3, words("c", 30)), (None, words("q", 9)), (4, "")], key=str)


def test_empty_documents(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        out = stage(spark, docs, path)
        assert out.count() == 0


def test_runs_on_the_small_tables(spark):
    before = spark.read.parquet(f"{SF}/documents.parquet").count()
    kept = cp.run(spark, SF).select("doc_id").distinct().count()
    assert 0.5 * before < kept < before


def test_line_stage_exempts_near_copies_only(spark):
    shared, other = "a footer line that all of these have", "and one more line of that kind here"
    rows = [(i, f"{words(f'd{i}x', 30)}\n{shared}\n\n{other}", None, None, 0) for i in range(12)]
    rows += [(20, f"{words('short', 3)}\n{shared}", None, None, 0), (21, f"{shared}\n{other}", None, None, 0), (22, shared, None, None, 0)]
    rows += [(30, f"{words('x', 40)}\n{shared}", None, None, 0), (31, f"{words('x', 40)}\n{shared}", None, None, 0)]
    rows += [(40 + i, f"{words('c', 40)}\n{words('e', 40)}\n{words('f', 9)} v{i}", None, None, 0) for i in range(11)]
    docs = spark.createDataFrame([(*r[:4], len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in cp.by_line(spark, docs, "").collect()}
    assert got[0].text == rows[0][1] and all(got[i].text == f"{words(f'd{i}x', 30)}\n" for i in range(1, 12))
    assert got[20].text == words("short", 3) and got[21].text == got[22].text == ""
    assert got[30].text == got[31].text == words("x", 40)     # copies of each other, not of the line's first holder
    assert all(got[40 + i].text == rows[17 + i][1] for i in range(11)) and all(r.n_chars == len(r.text) for r in got.values())


def test_line_stage_drops_long_passages_that_two_documents_share(spark):
    passage, shorter = words("p", 50), words("q", 49)
    rows = [(i, f"{words(f'd{i}x', 90)}\n{passage.upper() if i else passage}\n{shorter}", None, None, 0) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in cp.by_line(spark, docs, "").collect()}
    assert got == {i: rows[i][1] if not i else f"{words(f'd{i}x', 90)}\n{shorter}" for i in range(3)}
