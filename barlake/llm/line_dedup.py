"""Exact line de-duplication over a corpus, with DataFrame operations only.

Lines travel as 128-bit hashes of their keys with document and position, never
as text. Hashes are range-partitioned and sorted with document and position as
secondary keys, so a streaming pass over each partition sees a hash's
occurrences in order: it counts its documents, knows its first occurrence and
marks the lines to drop. The marks return to their documents as run-length
compressed keep bitmaps, and only then is text read again.

A line that very many documents share would make one long run. Such hashes are
found beforehand by a frequent-items sketch (its size is a constant, and so is
the list of at most ``HOT`` hashes); they are counted with partial aggregation
and marked by a broadcast of that list. The sketch only decides the route: a
frequent hash that it misses is counted by the sorted pass, with equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged

SPACE = " \t\n\x0b\x0c\r"
#: Hashes that may be routed as frequent, and items the sketch tracks (a power of two).
HOT, TRACKED = 256, 4096


def lines_of(text: Column) -> Column:
    """A text's lines; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(SPACE))
    ascii_only = F.octet_length(bare) == F.length(bare)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, upper, upper.lower()))


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2,
                  min_chars: int = 1, keep_first: bool = True, long_words: int | None = None, long_docs: int = 2) -> DataFrame:
    """(h1, h2, id, text_hash, pos, first): the lines to drop, as key hash and
    position, with the key's first occurrence (id, text_hash, pos).

    A key of at least ``min_chars`` code points found in at least ``min_docs``
    documents, or ``long_docs`` if it has ``long_words`` words, loses its lines:
    all but the first by (id, text hash, position) if ``keep_first``, else all."""
    text = F.col(text_col).cast("string")
    exploded = docs.select(F.col(id_col).alias("id"), _text_hash(text).alias("text_hash"),
                           F.posexplode(lines_of(text)).alias("pos", "line"))
    keyed = exploded.select("id", "text_hash", "pos", line_key(F.col("line")).alias("key")).where(
        F.length("key") >= max(min_chars, 0))
    need, kind = F.lit(min_docs), []
    if long_words is not None:  # a key of n words has 2 * n - 1 code points at least, so few are split
        is_long = F.when(F.length("key") >= 2 * long_words - 1, F.size(F.split("key", f"[{SPACE}]+")) >= long_words).otherwise(False)
        need, kind = F.when(F.col("long"), long_docs).otherwise(min_docs), [is_long.alias("long")]
    index = staged(keyed.select("id", "text_hash", "pos", F.xxhash64("key").alias("h1"),
                                F.xxhash64(F.lit(1), "key").alias("h2"), *kind), "lines")

    # At most HOT rows, so both lists below may be broadcast.
    top = index.agg(F.expr(f"approx_top_k(h1, {HOT}, {TRACKED})").alias("top"))
    hot = staged(top.select(F.explode("top.item").alias("h1")), "hot")
    order = ["id", "text_hash", "pos"]
    later = ~F.struct(*order).eqNullSafe(F.col("first"))

    often = index.join(F.broadcast(hot), "h1", "left_semi")
    key = ["h1", "h2"] + ["long"] * len(kind)
    in_doc = often.groupBy(*key, "id", "text_hash").agg(F.min("pos").alias("pos"))
    counted = in_doc.groupBy(*key).agg(F.count("*").alias("docs"), F.min(F.struct(*order)).alias("first"))
    counted = counted.where(F.col("docs") >= need)
    often = often.join(F.broadcast(counted), key)
    drop_often = often.where(later) if keep_first else often

    rest = index.join(F.broadcast(hot), "h1", "left_anti")
    run = Window.partitionBy("h1", "h2").orderBy(*order)
    rest = rest.repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", *order)
    same = F.lag("id").over(run).eqNullSafe(F.col("id")) & (F.lag("text_hash").over(run) == F.col("text_hash"))
    rest = rest.withColumn("nth", F.row_number().over(run)).withColumn("first", F.first(F.struct(*order)).over(run)).withColumn(
        "new", F.when((F.col("nth") > 1) & same, 0).otherwise(1))
    rest = rest.withColumn("docs", F.sum("new").over(run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    drop_rest = rest.where(F.col("docs") >= need)
    if keep_first:
        drop_rest = drop_rest.where(later)

    columns = ["h1", "h2", *order, "first"]
    return drop_often.select(*columns).unionByName(drop_rest.select(*columns))


def bitmaps_of(dropped: DataFrame) -> DataFrame:
    """(id, text_hash, n_dropped, keep_runs) of (id, text_hash, pos). keep_runs
    alternates lengths of kept and dropped runs, beginning with a kept run
    (perhaps 0 long); the rest is kept."""
    marked = dropped.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    return marked.select("id", "text_hash", F.size("at").cast("long").alias("n_dropped"), _runs(F.col("at")).alias("keep_runs"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2,
                 min_chars: int = 1, keep_first: bool = True) -> DataFrame:
    """:func:`bitmaps_of` the :func:`dropped_lines`, for every document that
    loses lines."""
    return bitmaps_of(dropped_lines(docs, id_col, text_col, min_docs, min_chars, keep_first))


def shingles_of(text: Column, words: int) -> Column:
    """Hashes of the distinct runs of ``words`` words, the near-duplicate
    operator's: white space apart, A-Z lower-cased; a shorter text is one run."""
    parts = F.filter(F.split(line_key(text), f"[{SPACE}]+"), lambda w: w != "")

    def runs(p: Column) -> Column:
        last = F.greatest(F.size(p) - words, F.lit(0))
        return F.array_distinct(F.transform(F.sequence(F.lit(1), last + 1), lambda k: F.xxhash64(F.slice(p, k, words))))

    # a lambda's argument is evaluated once, not once a run
    return F.transform(F.array(parts), lambda p: F.when(F.size(p) > 0, runs(p)))[0]


def lines_of_copies(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80) -> DataFrame:
    """(id, text_hash, pos): of the ``dropped`` lines those that a near copy of
    the document with their first occurrence holds; of several in it, its first.

    Only a document that would lose more than a quarter of its lines (blank ones
    do not count) is compared, with each document that is first for one of them:
    on full shingle sets, by the near-duplicate operator's rule. Rows with null
    ids, which that operator links with nothing, have no copies."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), _text_hash(text).alias("text_hash"), text.alias("t"))
    solid = F.size(F.filter(lines_of(F.col("t")), lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    lost = dropped.where("id IS NOT NULL").groupBy("id", "text_hash").agg(F.countDistinct("pos").alias("lost"))
    many = rows.select("id", "text_hash", solid.alias("lines")).distinct().join(lost, ["id", "text_hash"]).where("4 * lost > lines")
    held = dropped.join(many.select("id", "text_hash"), ["id", "text_hash"], "left_semi").withColumns(
        {"f_id": F.col("first.id"), "f_hash": F.col("first.text_hash")})
    held = held.where("f_id IS NOT NULL AND (f_id <> id OR f_hash <> text_hash)")
    held = staged(held.groupBy("h1", "h2", "id", "text_hash", "f_id", "f_hash").agg(F.min("pos").alias("pos")), "held")

    pairs = held.select("id", "text_hash", "f_id", "f_hash").distinct()
    ends = pairs.select("id", "text_hash").union(pairs.select("f_id", "f_hash")).distinct()
    sets = rows.join(ends, ["id", "text_hash"], "left_semi").dropDuplicates(["id", "text_hash"])
    sets = staged(sets.select("id", "text_hash", shingles_of(F.col("t"), words).alias("set")).where("set IS NOT NULL"), "sets")
    sizes = sets.select("id", "text_hash", F.size("set").cast("long").alias("n"))
    first = {"id": "f_id", "text_hash": "f_hash", "n": "f_n", "set": "f_set"}
    close = percent * F.greatest("n", "f_n") <= 100 * F.least("n", "f_n")
    pairs = pairs.join(sizes, ["id", "text_hash"]).join(sizes.withColumnsRenamed(first), ["f_id", "f_hash"]).where(close)
    pairs = pairs.join(sets, ["id", "text_hash"]).join(sets.withColumnsRenamed(first), ["f_id", "f_hash"])
    both = F.size(F.array_intersect("set", "f_set"))
    near = pairs.where(100 * both >= percent * (F.col("n") + F.col("f_n") - both)).select("id", "text_hash", "f_id", "f_hash")
    return held.join(near, ["id", "text_hash", "f_id", "f_hash"], "left_semi").select("id", "text_hash", "pos")


def _runs(at: Column) -> Column:
    """Sorted distinct positions to alternating kept and dropped run lengths."""
    starts = F.array_compact(F.zip_with(at, F.concat(F.array(F.lit(-2)), at), lambda x, p: F.when(x != p + 1, x)))
    after = F.concat(F.slice(at, 2, F.size(at)), F.array(F.lit(-2)))
    ends = F.array_compact(F.zip_with(at, after, lambda x, n: F.when(n != x + 1, x)))
    keeps = F.array_compact(F.zip_with(starts, F.concat(F.array(F.lit(-1)), ends), lambda s, e: s - e - 1))
    drops = F.zip_with(starts, ends, lambda s, e: e - s + 1)
    return F.flatten(F.zip_with(keeps, drops, lambda k, d: F.array(k, d)))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, n_lines, n_dropped, kept): every row of ``docs`` as a struct and its
    text without the dropped lines, joined by \\n."""
    text = F.col("row")[text_col].cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col("row")[id_col].alias("key_id"), _text_hash(text).alias("key_hash"))
    found = rows.join(bitmaps, F.col("key_id").eqNullSafe(F.col("id")) & (F.col("key_hash") == F.col("text_hash")), "left")
    lines = lines_of(text)
    known = F.flatten(F.transform("keep_runs", lambda n, i: F.array_repeat(i % 2 == 0, n)))
    flags = F.concat(known, F.array_repeat(F.lit(True), (F.size(lines) - F.size(known)).cast("int")))
    kept = F.array_join(F.zip_with(lines, flags, lambda line, keep: F.when(keep, line)), "\n")
    return found.select("row", F.size(lines).cast("long").alias("n_lines"),
                        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
                        F.when(F.col("keep_runs").isNull(), F.coalesce(text, F.lit(""))).otherwise(kept).alias("kept"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2,
                min_chars: int = 1, keep_first: bool = True) -> DataFrame:
    """:func:`keep_bitmaps` applied to ``docs``; see there for the rule.

    Defined cases: a document is an (id, text) pair, so exactly repeated rows
    count as one document and lose the same lines; ids may be null; a null or
    empty text is one empty line, which is never dropped while ``min_chars`` is
    at least 1; other columns, whatever their names, are passed through in the
    struct; an empty table gives an empty result."""
    bitmaps = keep_bitmaps(docs, id_col, text_col, min_docs, min_chars, keep_first)
    return apply_bitmaps(docs, bitmaps, id_col, text_col)
