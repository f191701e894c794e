"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that its predecessor kept and returns documents
with the same columns, the last one packed pieces. ``run`` writes every stage's
result as Parquet in the cluster's shared folder and reads it again, so a lost
executor never repeats an earlier stage.

A row is named by (doc_id, hash of its text): null ids, repeated rows and rows
with one id but several texts are handled as the operators define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.decontamination import MIN_RUN, leaks
from barlake.llm.language_id import language_id, train
from barlake.llm.line_dedup import apply_bitmaps, bitmaps_of, dropped_lines, lines_of_copies
from barlake.llm.near_duplicates import near_duplicates
from barlake.llm.packing import pack
from barlake.llm.staging import staged
from barlake.session import table

#: Documents that a line must occur in to be dropped after its first occurrence.
LINE_DOCS = 10
#: The same of lines with so many words: passages, which no later stage sees if
#: the documents are otherwise different.
LONG_WORDS, LONG_DOCS = 50, 2
#: Near copies: words of a shingle, least similarity.
WORDS, PERCENT = 5, 80
TOKENIZER, CAPACITY, END_ID = "word_bpe_49k.json", 4096, 2

#: The stages train, sketch and align; SQL cannot express them.
ORACLE_SQL = None


def _without(docs: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """``docs`` without the rows that ``gone`` (doc_id, text_hash) names. The list
    is staged first: its size is then known, and only a small one is broadcast."""
    gone = staged(gone.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct(), name)
    same = docs["doc_id"].eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_hash"])
    return docs.join(gone, same, "left_anti")


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in none of the languages, and those without letters."""
    found = language_id(docs, train(docs))
    return _without(docs, found.where(~F.col("kept")), "rejected")


def by_line(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that many documents share, and long ones that two share, but
    for their first occurrence. A
    near copy of the document that holds the first one keeps the line: the next
    stage takes the copy as a whole."""
    dropped = staged(dropped_lines(docs, min_docs=LINE_DOCS, keep_first=True, long_words=LONG_WORDS, long_docs=LONG_DOCS), "dropped")
    gone = dropped.join(lines_of_copies(docs, dropped, words=WORDS, percent=PERCENT), ["id", "text_hash", "pos"], "left_anti")
    out = apply_bitmaps(docs, bitmaps_of(gone))
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return out.select(*[F.when(F.col("n_dropped") > 0, new[c]).otherwise(F.col("row")[c]).alias(c) if c in new
                        else F.col("row")[c].alias(c) for c in docs.columns])


def by_near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the smallest id."""
    found = staged(near_duplicates(docs, words=WORDS, percent=PERCENT), "near")
    left = _without(docs, found.where(~F.col("kept")), "copies")
    again = found.where("kept").groupBy("doc_id", "text_hash").count().where("count > 1").drop("count")
    return _once(left, staged(again, "repeated"))


def _once(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """One row each of those that ``repeated`` names."""
    same = docs["doc_id"].eqNullSafe(repeated["doc_id"]) & (F.xxhash64(docs["text"]) == repeated["text_hash"])
    single = docs.join(repeated, same, "left_anti")
    return single.unionByName(docs.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def by_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that a benchmark item leaks into."""
    found = leaks(docs, table(spark, sf_dir, "benchmark"), min_run=MIN_RUN)
    return _without(docs, found.select(F.col("id").alias("doc_id"), "text_hash"), "leaks")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path(TOKENIZER), capacity=CAPACITY, end_id=END_ID)


STAGES = [("language_id", by_language), ("line_dedup", by_line), ("near_duplicates", by_near_duplicate),
          ("decontamination", by_benchmark), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
