"""Language ID: held-out accuracy, evidence, priors and defined cases."""

import numpy as np
import pytest

from barlake.llm.language_id import BINS, language_id, level, page_evidence, train, trigram_counts
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 3 <> 0"))


def test_held_out_accuracy_without_other_evidence(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 3 = 0")
    got = language_id(docs, model, declared_col=None, host_col=None).join(docs.select("doc_id", F.col("lang").alias("true")), "doc_id").collect()
    assert len(got) == docs.count()
    assert np.mean([r.lang == r.true for r in got]) > 0.95 and np.mean([r.kept for r in got]) > 0.99


def test_pages_by_text_markup_and_host(spark, model):
    pages = page_evidence(spark.read.parquet(f"{SF}/pages.parquet"))
    got = language_id(pages, model, id_col="page_id").join(pages.select("page_id", F.col("lang").alias("true")), "page_id").collect()
    assert np.mean([r.lang == r.true for r in got]) > 0.95


def test_evidence_decides_what_the_text_leaves_open(spark, model):
    sure = [(i, "Und die der ist nicht für sich auch eine schung keit", "de", "a.beispiel.at") for i in range(40)]
    rows = sure + [(100, "xq", "de", None), (101, "xq", None, "a.beispiel.at"), (102, "xq", None, "new.beispiel.at"), (103, "xq", None, None)]
    got = {r.doc_id: r for r in language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), model).collect()}
    assert {got[i].lang for i in (100, 101, 102)} == {"de"} and all(r.kept for r in got.values())
    assert got[101].confidence > got[103].confidence


def test_other_scripts_are_rejected_and_odd_rows_defined(spark, model):
    clean = [(i, "the of and to in is that it was for on are as with his they", "en", f"h{i % 3}.com") for i in range(30)]
    rows = clean + [(50, "Это совсем другой язык и письмо " * 20, "en", "h1.com"), (51, None, "en", "h1.com"), (52, "", None, None),
                    (53, "123 %%% 456", "xx", ".."), (None, "the of and to in", "en", ""), (54, "the of and " * 200_000, "en", "h1.com"), (54, "the of and", "EN", "H1.com")]
    docs = spark.createDataFrame([(*r, 0.5, 1) for r in rows], "doc_id long, text string, lang string, source string, p double, prior int")
    got = language_id(docs, model).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: (r.lang, r.kept) for r in got}
    assert kept[50] == ("und", False) and not kept[51][1] and not kept[52][1] and not kept[53][1]
    assert kept[None] == kept[54] == ("en", True) and all(kept[i] == ("en", True) for i in range(30))
    assert language_id(docs.limit(0), model).count() == 0
    assert train(docs.limit(0)).shape == (4, BINS)


def test_host_levels(spark):
    df = spark.createDataFrame([("a.b.c",), ("c",), (None,)], "h string")
    assert [tuple(r) for r in df.select(*[level(F.col("h"), k).alias(str(k)) for k in range(4)]).collect()] == [
        ("a.b.c", None, "b.c", "c"), ("c", None, None, None), (None, None, None, None)]


def test_trigrams_of_long_texts_are_all_counted():
    text = ("abc défg " * 300_000).encode()
    one = trigram_counts(b"abc d\xc3\xa9fg " * 300)
    assert trigram_counts(text).sum() == 1000 * one.sum() and trigram_counts(None).sum() == 0 == trigram_counts(b"12 ?!").sum()


def test_markup_and_address(spark):
    pages = spark.createDataFrame([(1, "HTTPS://u.example.FR:80/x", "<HTML class=a LANG='fr-CA'><script>x</script>a<b>c<!-- d -->"), (2, None, None)],
                                  "page_id long, url string, html string")
    got = [tuple(r) for r in page_evidence(pages).orderBy("page_id").collect()]
    assert (got[0][1].split(), got[0][2:]) == (["a", "c"], ("fr", "u.example.fr")) and got[1] == (2, "", None, None)


def test_query_judges_documents_and_pages(spark):
    from barlake.llm.bindings import op9_language_id

    sf = "/root/testdata/sf0.001"
    docs, pages = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/pages.parquet")
    got = op9_language_id(spark, sf).collect()
    assert sorted(r.doc_id for r in got if r.page_id is None) == sorted(r.doc_id for r in docs.collect())
    found = {r.page_id: r.lang for r in got if r.doc_id is None}
    said = {r.page_id: r.lang for r in page_evidence(pages).collect()}
    assert set(found) == set(said) and len(got) == docs.count() + pages.count()
    assert np.mean([found[p] == lang for p, lang in said.items() if lang]) > 0.95


def test_levels_are_counted_from_the_right(spark):
    df = spark.createDataFrame([("a.b.c.d.example.com",), ("www.example.com",), ("com",)], "h string")
    assert [tuple(r) for r in df.select(*[level(F.col("h"), k).alias(str(k)) for k in range(4)]).collect()] == [
        ("a.b.c.d.example.com", "d.example.com", "example.com", "com"), ("www.example.com", None, "example.com", "com"), ("com", None, None, None)]


def test_broken_markup_takes_linear_time(spark):
    import time

    hostile = [piece * (1_000_000 // len(piece)) for piece in ("<script", "<script>", "<!--", "<", "<html", "<html ", "lang=", "</script ", "<style></script>", "<a")]
    pages = spark.createDataFrame(list(enumerate(hostile)), "page_id int, html string").selectExpr("page_id", "'http://x.org/' AS url", "html").repartition(4)
    at = time.monotonic()
    assert page_evidence(pages).selectExpr("sum(length(text))", "count(lang)").first()[1] == 0
    assert time.monotonic() - at < 30
    good = spark.createDataFrame([(1, "http://x.org", "a<script>no</script >b<!-- no -->c<style>no</STYLE>d<p class='x'>1 < 2 e<script>never closed")],
                                 "page_id int, url string, html string")
    assert "".join(page_evidence(good).first().text.split()) == "abcd1<2e"
