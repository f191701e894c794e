"""URL allow and block rules by hashed expressions.

Every URL is expanded into host-suffix and path-prefix expressions, in the
shapes (labels of the host, length of the path) that the rules have. The
expressions join the rules on a short prefix of their digests; a full digest
confirms a match, and the longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of a digest that form the join key.
PREFIX = 8
DEFAULT = "allow"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def prepared(rules: DataFrame) -> DataFrame:
    """(rule, verdict, labels, chars, digest, prefix) of rules (host, path, verdict)."""
    host = F.translate("host", _UPPER, _UPPER.lower())
    path = F.coalesce("path", F.lit(""))
    out = rules.where("host IS NOT NULL AND host <> ''").select(
        F.concat(host, path).alias("rule"), "verdict", _labels(host).alias("labels"), F.length(path).alias("chars"))
    return out.withColumn("digest", F.sha2("rule", 256)).withColumn("prefix", F.substring("digest", 1, PREFIX))


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The host's last ``labels`` labels with the path's first ``chars``
    characters, for every shape that the URL is long enough for."""
    if not shapes:
        return F.array().cast("array<string>")
    known = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(c).alias("chars")) for n, c in shapes])
    return F.array_compact(F.transform(known, lambda s: F.when(
        (_labels(host) >= s["labels"]) & (F.length(path) >= s["chars"]),
        F.concat(F.call_function("substring_index", host, F.lit("."), -s["labels"]), F.substring(path, F.lit(1), s["chars"])))))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """(row, host, path, rule, verdict): every row of ``pages`` as a struct.

    A rule (host, path, verdict) fits its host and all subdomains if the URL's
    path starts with the rule's. Of several the longest (host and path together)
    wins, of equally long ones "block", then the last in text order. Without a rule
    the verdict is ``default`` and rule is null.

    Defined cases: a null URL, or one without ``://``, has an empty host and path
    and gets ``default``; repeated rows each keep their row; other columns are
    passed through in the struct; without rules every URL gets ``default``.

    URLs are judged once each, however many pages share one. The shapes are
    collected: one row per distinct (labels, length), which is bounded by the
    longest host and path of a rule, not by the number of rules or pages."""
    known = prepared(rules)
    shapes = [(r.labels, r.chars) for r in known.select("labels", "chars").distinct().collect()]
    url = F.col("url")
    urls = pages.select(F.col(f"`{url_col}`").cast("string").alias("url")).where("url IS NOT NULL").distinct()
    tried = urls.select("url", F.explode(F.array_distinct(expressions(host_of(url), path_of(url), shapes))).alias("expression"))
    tried = tried.withColumn("full", F.sha2("expression", 256)).withColumn("prefix", F.substring("full", 1, PREFIX))
    hits = tried.join(known.select("rule", "verdict", "digest", "prefix"), "prefix").where(F.col("full") == F.col("digest"))
    rank = F.struct(F.length("rule"), (F.col("verdict") == "block"), F.col("rule"))
    best = hits.groupBy("url").agg(F.max_by(F.struct("rule", "verdict"), rank).alias("best"))

    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"))
    rows = rows.withColumn("page_url", F.col("row")[url_col].cast("string"))
    found = rows.join(best, F.col("page_url") == F.col("url"), "left")
    return found.select("row", host_of(F.col("page_url")).alias("host"), path_of(F.col("page_url")).alias("path"),
                        F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
