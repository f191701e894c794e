"""One query per operator, over whole tables and with production parameters,
and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from .decontamination import MIN_RUN, leaks
from .exact_top_k import exact_top_k
from .hard_negatives import hard_negatives
from .importance import resample
from .language_id import language_id, page_evidence, train
from .licenses import license_scan
from .line_dedup import dedup_lines
from .near_duplicates import near_duplicates
from .packing import pack
from .personal_data import KINDS, personal_data, spelled
from .personal_data import train as train_detector
from .staging import fresh
from .token_counts import token_counts
from .url_filters import judge_urls
from .warc import salvage, write_archive

TOKENIZER = "word_bpe_49k.json"
#: Fixed by the contract: (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path, min_bytes=0)
    records, _ = salvage(spark, path, payloads=False)
    return records.select(F.expr("try_cast(record_id AS long)").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          F.expr("try_cast(refers_to AS long)").alias("refers_to"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=2048)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1, keep_first=False)
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP3_SQL = """
WITH bare AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM bare),
often AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, o.key IS NOT NULL AS gone FROM keyed k LEFT JOIN often o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that benchmark items leak into, with the items."""
    out = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), min_run=MIN_RUN)
    return out.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "score", F.col("start").alias("start_word"),
                      F.col("stop").alias("stop_word"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), k=5, scale=256, query_every=50)


OP5_SQL = """
WITH valid AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS codes
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         CAST(list_sum(list_transform(list_zip(q.codes, d.codes), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM valid q JOIN valid d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, URL_RULES))} AS rules(host, path, verdict)")
    out = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return out.select("row.page_id", "host", "path", "rule", "verdict")


OP6_SQL = """
WITH rules(rhost, rpath, rverdict) AS (VALUES
  ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (
  SELECT p.*, rhost || rpath AS rule, rverdict, row_number() OVER (
           PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST, rverdict DESC) AS rn
  FROM parts p LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM fits WHERE rn = 1
"""


def op7_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), capacity=4096, end_id=2)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for every document and, with a null doc_id, one for every page.
    Pages have declared languages, suffixes and parent domains as evidence; the
    model is the documents'."""
    docs, pages = table(spark, sf_dir, "documents"), page_evidence(table(spark, sf_dir, "pages"))
    model = train(docs)
    found = language_id(docs, model).withColumn("page_id", F.lit(None).cast(pages.schema["page_id"].dataType))
    of_pages = language_id(pages, model, id_col="page_id").withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType))
    return found.unionByName(of_pages).select("doc_id", "lang", "confidence", "kept", "page_id")


def op10_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85).drop("text_hash")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents")
    found = personal_data(docs, train_detector(docs))
    counts = [F.expr(f"CAST(size(filter(base, x -> x.name = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(spelled("base"), 256).alias("base_sha256"),
                        spelled(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"))


OP12_SQL = """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS codes
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         CAST(list_sum(list_transform(list_zip(a.codes, r.codes), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM valid a JOIN valid r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
   AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=5)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


_QUERIES = (op1_warc_salvage, op2_token_counts, op3_line_dedup, op4_benchmark_decontamination, op5_exact_top_k,
            op6_url_filters, op7_harmonic_packing, op8_license_scan, op9_language_id, op10_minhash_near_duplicates,
            op11_personal_data, op12_hard_negatives, op13_importance_resampling)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": OP3_SQL, "op5_exact_top_k": OP5_SQL, "op6_url_filters": OP6_SQL,
            "op12_hard_negatives": OP12_SQL}
