"""Language identification by Bayesian evidence fusion.

P(language | row) is proportional to the product of

* the text likelihood: naive Bayes over hashed letter trigrams of the whole
  text, tempered because neighbouring trigrams are not independent;
* the declared markup language and the address suffix: P(value | language),
  smoothed, from grouped counts over all rows;
* the host prior: P(language | host), smoothed towards its parent domain, that
  towards the next one up, and the top towards the whole table. Every level is a
  grouped aggregation of the rows' text posteriors.

A background class, uniform over trigrams, stands for everything that is none of
the languages; a row that it wins, or without letters, is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged
from .words import utf8

LANGUAGES = ("en", "de", "fr", "es")
BACKGROUND = "und"
#: Hashed trigrams; divisor of a text's log likelihood; prior of the background.
BINS, TEMPER, BACKGROUND_PRIOR = 1 << 13, 8.0, 1e-3
NEVER = -30.0
#: Pseudo-counts of a host's prior (towards its parent) and of P(value | language).
HOST_WEIGHT, VALUE_WEIGHT = 20.0, 2.0
#: Levels of a host that have a prior of their own: the host, and its last three,
#: two and one labels.
LEVELS = 4

_LETTERS = bytes(c if c > 127 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def trigram_counts(text: bytes | None) -> np.ndarray:
    """Counts of hashed byte trigrams; everything ASCII but letters is a space,
    and trigrams around runs of spaces are not counted."""
    out = np.zeros(BINS, np.int64)
    text = b" " + (text or b"").translate(_LETTERS) + b" "
    for k in range(0, len(text), 1 << 20):
        u = np.frombuffer(text[k:k + (1 << 20) + 2], np.uint8).astype(np.uint32)
        if len(u) < 3:
            break
        h = ((u[:-2] << 16) | (u[1:-1] << 8) | u[2:]) * np.uint32(2654435761)
        solid = (u[1:-1] != 32) & ((u[:-2] != 32) | (u[2:] != 32))
        out += np.bincount(h[solid] >> np.uint32(32 - 13), minlength=BINS)
    return out


def train(docs: DataFrame, text_col: str = "text", label_col: str = "lang", languages: Sequence[str] = LANGUAGES) -> np.ndarray:
    """Log likelihoods (language, trigram) from all labelled rows: at most
    len(languages) * BINS counts reach the driver. A language without labelled
    text is never chosen by its text."""
    names = list(languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(names), BINS), np.int64)
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), utf8(batch.column("t"))):
                sums[names.index(label)] += trigram_counts(text)
        label, bin_ = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(bin_), pa.array(sums[label, bin_])], names=["label", "bin", "n"])

    label = F.lower(F.col(label_col).cast("string"))
    rows = docs.select(label.alias("label"), F.col(text_col).cast("string").alias("t")).where(F.col("label").isin(names))
    counts = rows.mapInArrow(run, "label long, bin long, n long").groupBy("label", "bin").agg(F.sum("n").alias("n"))
    table = np.full((len(names), BINS), 0.5)
    for r in counts.collect():
        table[r.label, r.bin] += r.n
    unseen = table.max(axis=1, keepdims=True) < 1
    return np.where(unseen, NEVER, np.log(table / table.sum(axis=1, keepdims=True)))


def _scored(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """``rows`` (row, t, ...) with grams and log_text, an array over languages and
    the background, tempered; ``t`` goes."""
    rest = [f for f in rows.schema.fields if f.name != "t"]
    weights = np.vstack([model, np.full(BINS, -np.log(BINS))])
    spread = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, logs = [], []
            for text in utf8(batch.column("t")):  # one table of counts at a time
                counts = trigram_counts(text)
                grams.append(int(counts.sum()))
                logs.append((spread.value @ counts) / TEMPER)
            columns = [batch.column(f.name) for f in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(grams, pa.int64()), pa.array(logs, pa.list_(pa.float64()))],
                                             names=[*(f.name for f in rest), "grams", "log_text"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    return rows.mapInArrow(run, f"{kinds}, grams long, log_text array<double>")


def _posterior(log: Column) -> Column:
    """Normalised exponentials."""
    raw = F.transform(log, lambda x: F.exp(x - F.array_max(log)))
    return F.transform(raw, lambda x: x / F.aggregate(raw, F.lit(0.0), lambda a, v: a + v))


def level(host: Column, up: int) -> Column:
    """Level 0 is the host; the others are counted from the right, so every host of a
    domain shares them however deep it is: the last ``LEVELS - up`` labels, null if
    the host has no more."""
    if not up:
        return host
    labels, n = F.split(host, r"\.", -1), LEVELS - up
    return F.when(F.size(labels) > n, F.array_join(F.slice(labels, -n, n), "."))


def _sums(n: int, prefix: str) -> list[Column]:
    return [F.sum(F.col("p")[k]).alias(f"{prefix}{k}") for k in range(n)]


def language_id(rows: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
                declared_col: str | None = "lang", host_col: str | None = "source",
                languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """(id, text_hash, lang, confidence, kept): one row for every row.

    lang is the language of the highest posterior, or "und"; kept is false for
    "und" and for texts without letters. ``host_col`` is a host or any name of a
    source; its last label is the address suffix if it has several.

    Defined cases: a null or empty text is rejected, whatever the other evidence,
    and its lang is what that says; a null declaration, host or suffix is no
    evidence; ids may be null or repeated; an unknown declaration counts like any
    other value; other columns are not looked at; an empty table gives an empty
    result."""
    n = len(languages) + 1
    text = F.col(text_col).cast("string")
    host = F.lower(F.col(host_col).cast("string")) if host_col else F.lit(None).cast("string")
    declared = F.lower(F.col(declared_col).cast("string")) if declared_col else F.lit(None).cast("string")
    base = rows.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("t"),
                       declared.alias("declared"), host.alias("host"))
    scored = staged(_scored(base, model), "scored")
    prior = F.array(*[F.lit(float(np.log((1 - BACKGROUND_PRIOR) / (n - 1))))] * (n - 1), F.lit(float(np.log(BACKGROUND_PRIOR))))
    with_text = scored.where("grams > 0").withColumn("p", _posterior(F.zip_with("log_text", prior, lambda a, b: a + b)))

    # Priors of the table (one row) and of every level of a host, each smoothed by the one above.
    total = [F.sum(F.col("p")[k]) for k in range(n)]
    whole = with_text.agg(*[F.coalesce(t, F.lit(0.0)).alias(f"t{k}") for k, t in enumerate(total)]).first()
    mass = sum(whole) + n
    top = [(whole[k] + 1) / mass for k in range(n - 1)] + [BACKGROUND_PRIOR]
    hosts = with_text.where("host IS NOT NULL").groupBy("host").agg(*_sums(n, "s"))
    levels = hosts.select("host", F.posexplode(F.array(*[level(F.col("host"), up) for up in range(LEVELS)])).alias("up", "at"),
                          *[f"s{k}" for k in range(n)]).where("at IS NOT NULL")
    sums = staged(levels.groupBy("at").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(n)]), "levels")
    priors = hosts.select("host")
    above = F.array(*map(F.lit, top))
    priors = priors.withColumn("prior", above)
    for up in reversed(range(LEVELS)):
        at = sums.withColumnRenamed("at", "up_host")
        joined = priors.join(at, level(F.col("host"), up) == F.col("up_host"), "left")
        seen = F.array(*[F.coalesce(f"s{k}", F.lit(0.0)) for k in range(n)])
        size = F.aggregate(seen, F.lit(0.0), lambda a, v: a + v)
        priors = joined.withColumn("prior", F.zip_with(seen, "prior", lambda s, p: (s + HOST_WEIGHT * p) / (size + HOST_WEIGHT)))
        priors = priors.select("host", "prior")
    priors = staged(priors, "priors")

    def likelihood(column: Column, name: str) -> DataFrame:
        """(value, log P(value | language)) with the value's overall share as base."""
        counts = with_text.withColumn(name, column).where(F.col(name).isNotNull()).groupBy(name).agg(*_sums(n, "s"))
        all_ = counts.agg(*[F.coalesce(F.sum(f"s{k}"), F.lit(0.0)).alias(f"a{k}") for k in range(n)]).first()
        everything = max(sum(all_), 1e-9)
        share = sum(F.col(f"s{k}") for k in range(n)) / everything
        logs = [F.log((F.col(f"s{k}") + VALUE_WEIGHT * share) / (all_[k] + VALUE_WEIGHT)) for k in range(n)]
        return staged(counts.select(name, F.array(*logs).alias(f"log_{name}")), name)

    suffix = F.when(F.size(F.split("host", r"\.", -1)) > 1, F.element_at(F.split("host", r"\.", -1), -1))
    out = scored.withColumn("suffix", suffix)
    out = out.join(likelihood(F.col("declared"), "declared"), "declared", "left")
    out = out.join(likelihood(suffix, "suffix"), "suffix", "left").join(priors, "host", "left")
    log = F.transform(F.coalesce("prior", above), lambda x: F.log(F.greatest(x, F.lit(1e-9))))
    for part in ("log_text", "log_declared", "log_suffix"):
        none = F.array_repeat(F.lit(0.0), n)
        log = F.zip_with(log, F.coalesce(F.col(part), none), lambda a, b: a + b)
    out = out.select("id", "text_hash", "grams", log.alias("log")).withColumn("p", _posterior(F.col("log")))
    names = F.array(*[F.lit(x) for x in (*languages, BACKGROUND)])
    confidence = F.array_max("p")
    out = out.withColumn("lang", F.element_at(names, F.array_position("p", confidence).cast("int")))
    return out.select(F.col("id").alias(id_col), "text_hash", "lang", confidence.alias("confidence"),
                      ((F.col("lang") != BACKGROUND) & (F.col("grams") > 0)).alias("kept"))


def page_evidence(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, text, lang, source) of web pages: text without scripts, styles and
    tags, the language that the markup declares, and the URL's host. A script, style
    or comment that is not closed lasts to the end, a tag to the next one; a "<" that
    begins no tag is text."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    # Possessive, and what is never closed runs to the end: one pass however broken the markup is.
    text = F.regexp_replace(html, r"(?is)<(script|style)\b(?:(?!</\1\s*+>).)*+(?:</\1\s*+>)?|<!--(?:(?!-->).)*+(?:-->)?|<(?=[a-z/!?])[^<>]*+>?", " ")
    attributes = F.regexp_extract(html, r"(?i)<html\b([^>]*+)", 1)
    lang = F.regexp_extract(attributes, r"(?i)\blang\s*+=\s*+[\"']?([a-z]++)", 1)
    host = F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"://([^/?#:]+)", 1)
    return pages.select(F.col(id_col).alias(id_col), text.alias("text"), F.when(lang != "", F.lower(lang)).alias("lang"),
                        F.when(host != "", F.lower(host)).alias("source"))
