"""Personal data by candidate gradient boosting, in DataFrame functions only.

1. Base spans: a regular expression and a check for each kind (Luhn, octets,
   number of digits). They are always reported.
2. Generators with high recall propose further spans in what the base spans of
   the kind leave: spelled-out mail addresses, addresses with bracketed dots,
   cards and phone numbers in other groupings. Most of these are no personal data.
3. Every candidate becomes a vector of small integers: format (digits, length,
   separators, the kind's check) and context (characters next to it, a telling
   word before it).
4. Boosted trees, one model a kind, score the vectors. They learn from a bounded
   sample of documents: base spans spelled anew in their own context are examples,
   as are broken ones (a wrong check digit, an impossible octet) and the plain
   candidates, which count as negative. What is fitted is a table of distinct
   vectors with counts, and the model comes back as one column expression.
5. A candidate is reported if its score reaches the kind's threshold, the lowest
   one with the wanted precision on held-out documents; a kind without examples
   reports none.

Everything about a document happens in its own row: no exchange, no Python on the
executors. Positions are running sums over the pieces that a split leaves, taken
in blocks, so a long text with many spans costs little more than its length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted, fit, threshold
from .staging import staged

#: Documents of the sample that the trees learn from (about: a hash picks them),
#: share of it that sets the thresholds, precision there, weight of an example that
#: was spelled anew, least weight of positive examples above a threshold.
SAMPLE_DOCS, HELD_OUT, PRECISION, RESPELLED, LEAST_POSITIVE = 20000, 4, 0.9, 0.25, 1.0
#: Share of arbitrary candidates that pass the kind's check all the same (a check
#: digit): of the plain candidates that pass, only so many count as negative.
BY_CHANCE = {"card": 0.1}
#: Code points before and after a span that its context features see.
BEFORE, AFTER = 40, 4
#: Elements that are summed one by one; above them, blocks are.
BLOCK = 512

#: Fixed by the contract: kinds in their order, patterns, checks. The patterns are
#: written so that they never backtrack: a run is entered at its start or where the
#: last match ended.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: An octet of at most 255, with any number of leading zeros.
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CHECKS = {
    "email": "true",
    "ip": rf"span RLIKE '^{_OCTET}(?:\\.{_OCTET}){{3}}$'",
    "card": "length(digits) BETWEEN 12 AND 19 AND luhn_check(digits)",
    "phone": "length(digits) BETWEEN 9 AND 15",
}

_AT = r"\x20?(?:@|\(at\)|\[at\]|\{at\}|\(@\)|\[@\])\x20?"
_DOT = r"(?:\x20?(?:\(dot\)|\[dot\]|\{dot\}|\(\.\)|\[\.\])\x20?|\x20dot\x20|\.)"
#: The bare words count only together: prose has "at" everywhere.
_LABEL = r"[A-Za-z0-9-]++"
_POINT = r"\x20?(?:\.|,|\[\.\]|\(\.\)|\(dot\)|\[dot\])\x20?"
GENERATORS = {
    "email": rf"(?i)(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:{_AT}{_LABEL}(?:{_DOT}{_LABEL}){{1,8}}+|\x20at\x20{_LABEL}(?:\x20dot\x20{_LABEL}){{1,8}}+)",
    "ip": rf"(?i)(?<![0-9.,])[0-9]{{1,3}}(?:{_POINT}[0-9]{{1,3}}){{3}}(?![0-9])|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{{1,4}}:){{7}}[0-9A-Fa-f]{{1,4}}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9+(])(?:\(?[0-9]{2,4}\)?[\x20./-]{1,2}[0-9]{3}[\x20./-]{1,2}[0-9]{4}|00[1-9](?:[\x20().-]{0,2}[0-9]){7,12})(?![0-9])",
}
#: A text without this has no candidate of the kind.
GATES = {"email": r"@|(?i:\bdot\b)", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
#: What a candidate of the kind looks like when it is well formed.
FORMS = {
    "email": "span RLIKE '^[^\\\\s]*[A-Za-z]' AND span RLIKE '[^A-Za-z0-9][A-Za-z]{2,12}$'",
    "ip": rf"regexp_replace(lower(span), '[^0-9]+', '.') RLIKE '^{_OCTET}(?:\\.{_OCTET}){{3}}$' OR span RLIKE '^(?:[0-9A-Fa-f]{{1,4}}:){{7}}'",
    "card": "luhn_check(digits)",
    "phone": r"span RLIKE '^(?:\\(?[0-9]{3}\\)?[\\x20./-]{1,2}[0-9]{3}[\\x20./-][0-9]{4}|00[1-9].*)$'",
}
#: Words that tell the kind, before the span.
WORDS = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|reach|address|correo|courriel)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|login|from|client|addr)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|pan|payment|tarjeta|karte|carte)\b",
    "phone": r"(?i)\b(?:tel|telephone|phone|call|mobile|cell|fax|telefon|móvil|téléphone)\b",
}
#: Base spans spelled anew.
SPELLINGS = {
    "email": ["concat(split_part(span, '@', 1), ' at ', replace(split_part(span, '@', 2), '.', ' dot '))",
              "concat(split_part(span, '@', 1), ' [at] ', replace(split_part(span, '@', 2), '.', ' [dot] '))",
              "concat(split_part(span, '@', 1), '(at)', replace(split_part(span, '@', 2), '.', '(dot)'))"],
    "ip": ["replace(span, '.', '[.]')", "replace(span, '.', ' . ')", "replace(span, '.', '(dot)')"],
    "card": [r"regexp_replace(digits, '([0-9]{4})(?=[0-9])', '$1.')", r"regexp_replace(digits, '([0-9]{4})(?=[0-9])', '$1/')",
             r"regexp_replace(digits, '([0-9]{4})(?=[0-9])', '$1  ')", "concat(span, ' ', span)"],
    "phone": [r"regexp_replace(span, '^\\+[0-9]{1,3}[\\x20.-]+', '')", "concat('00', digits)",
              r"regexp_replace(right(digits, 10), '^([0-9]{3})([0-9]{3})', '$1.$2.')"],
}
#: What makes a base span one that fails its check; spelled anew like the others.
BROKEN = {
    "email": ["regexp_replace(span, '[.][^.]*$', '.1')"],
    "ip": ["concat('3', lpad(split_part(span, '.', 1), 2, '0'), substring(span, locate('.', span)))", "regexp_replace(span, '[0-9]+$', '999')",
           "replace(span, '.', ',')"],
    "card": ["concat(left(span, length(span) - 1), (CAST(right(span, 1) AS INT) + 1) % 10)",
             "concat((CAST(left(span, 1) AS INT) + 3) % 10, substring(span, 2))"],
    "phone": ["regexp_replace(span, '[0-9]{2}$', '')", "concat(left(span, length(span) - 4), '-1')"],
}
FEATURES = ["digits", "size", "marks", "uniform", "bracket", "form", "word", "before", "after"]


@dataclass
class Detector:
    """Per kind: boosted trees and the log-odds from which a candidate counts."""

    models: dict[str, tuple[Boosted, float]]


def _running(widths: str) -> str:
    """Running sums of an array of longs; blocks first, so that a long array is
    not copied for every element."""
    blocks = f"transform(sequence(0, greatest(size({widths}) - 1, 0) div {BLOCK}), b -> slice({widths}, CAST(b * {BLOCK} + 1 AS INT), {BLOCK}))"
    total = "(block, 0L, (a, x) -> a + x)"
    return (f"flatten(transform({blocks}, (block, i) -> slice(aggregate(block, array(element_at(aggregate(transform("
            f"slice({blocks}, 1, CAST(i AS INT)), block -> aggregate{total}), array(0L), (a, x) -> array(element_at(a, 1) + x)), 1)), "
            f"(a, x) -> array_append(a, element_at(a, -1) + x)), 2, {BLOCK})))")


def _found(df: DataFrame, text: str, pattern: str, gate: str, name: str) -> DataFrame:
    """``df`` with ``name``: every match of ``pattern`` in column ``text`` as
    (span, before, after, start, stop), and ``name``_parts: what is between."""
    found, parts, widths, ends = (f"_{x}_{name}" for x in ("found", "parts", "widths", "ends"))
    some = F.when(F.col(text).rlike(gate), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    df = df.withColumn(found, some)
    df = df.withColumn(parts, F.when(F.size(found) > 0, F.split(text, pattern, -1)).otherwise(F.array(F.col(text))))
    df = df.withColumn(widths, F.expr(f"transform({found}, (x, i) -> CAST(length({parts}[i]) + length(x) AS BIGINT))"))
    df = df.withColumn(ends, F.expr(f"CASE WHEN size({widths}) > 0 THEN {_running(widths)} ELSE array() END"))
    context = f"right(concat(IF(i > 0, concat(right({parts}[i - 1], {BEFORE}), {found}[i - 1]), ''), {parts}[i]), {BEFORE})"
    return df.withColumn(name, F.expr(
        f"transform({found}, (x, i) -> struct(x AS span, {context} AS before, left({parts}[i + 1], {AFTER}) AS after, "
        f"{ends}[i] - length(x) AS start, {ends}[i] AS stop, regexp_replace(x, '[^0-9]', '') AS digits))")).drop(widths, ends)


def _field(sql: str) -> str:
    """The expression on a span's fields, for use inside a lambda over x."""
    return re.sub(r"\b(span|digits)\b(?![\w(])", r"x.\1", sql)


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` with base_K, the checked base spans of every kind K, and rest: the text
    with all those replaced by as many object characters."""
    df = df.withColumn("rest", F.col(text))
    for kind in KINDS:
        found, masked = f"all_{kind}", f"_masked_{kind}"
        gate = "@" if kind == "email" else "[0-9]"
        df = _found(df, text, BASE[kind], gate, found)
        df = df.withColumn(f"base_{kind}", F.expr(f"filter({found}, x -> {_field(CHECKS[kind])})"))
        # most texts have none: the second search is for the others alone
        some = f"size(base_{kind}) > 0"
        pattern = _quoted(BASE[kind])
        df = df.withColumn(masked, F.expr(f"CASE WHEN {some} THEN transform(regexp_extract_all(rest, '{pattern}', 0), "
                                          "s -> struct(s AS span, regexp_replace(s, '[^0-9]', '') AS digits)) END"))
        df = df.withColumn(f"_pieces_{kind}", F.expr(f"CASE WHEN {some} THEN split(rest, '{pattern}', -1) END"))
        hidden = (f"transform({masked}, x -> IF({_field(CHECKS[kind])}, repeat('\ufffc', length(x.span)), x.span))")
        df = df.withColumn(masked, F.expr(hidden))
        df = df.withColumn("rest", F.expr(f"IF({some}, array_join(transform(_pieces_{kind}, (p, i) -> concat(p, IF(i < size({masked}), "
                                          f"{masked}[i], ''))), ''), rest)"))
        df = df.drop(found, masked, f"_pieces_{kind}", f"_parts_{found}", f"_found_{found}")
    return df


def _vector(kind: str) -> str:
    """The features of a candidate x as an SQL struct with its place."""
    marks = "regexp_replace(x.span, '[0-9A-Za-z]+', '')"

    def edge(char: str) -> str:
        return f"CASE WHEN {char} = '' OR {char} RLIKE '^\\\\s' THEN 0 WHEN {char} RLIKE '^[0-9]' THEN 1 WHEN {char} RLIKE '^[\\\\p{{L}}]' THEN 2 WHEN {char} RLIKE '^[=\"_/:#]' THEN 3 ELSE 4 END"

    fields = {
        "digits": "least(length(x.digits), 24)", "size": "least(length(x.span) div 4, 16)", "marks": f"least(length({marks}), 12)",
        "uniform": f"IF(length(replace({marks}, left({marks}, 1), '')) = 0, 1, 0)", "bracket": "IF(x.span RLIKE '[(\\\\[{{]', 1, 0)".replace("{{", "{"),
        "form": f"IF({_field(FORMS[kind])}, 1, 0)", "word": f"IF(x.before RLIKE '{_quoted(WORDS[kind])}', 1, 0)",
        "before": edge("right(x.before, 1)"), "after": edge("left(x.after, 1)"),
    }
    return "struct(x.start AS start, x.stop AS stop, " + ", ".join(f"{fields[n]} AS {n}" for n in FEATURES) + ")"


def _quoted(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def candidates(df: DataFrame, kind: str, text: str) -> DataFrame:
    """``df`` with cand_K: the generator's spans in ``text`` as feature vectors."""
    df = _found(df, text, GENERATORS[kind], GATES[kind], f"cand_{kind}")
    return df.withColumn(f"cand_{kind}", F.expr(f"transform(cand_{kind}, x -> {_vector(kind)})")).drop(f"_parts_cand_{kind}", f"_found_cand_{kind}")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))


def _examples(sample: DataFrame) -> DataFrame:
    """(kind, held, FEATURES, yes, no): distinct feature vectors of the sample with
    the weights of their positive and negative examples."""
    based = base_spans(sample.withColumn("held", F.pmod(F.xxhash64("t", F.lit(1)), F.lit(HELD_OUT)) == 0), "t")
    based = staged(based.drop("t"), "sample")  # eight tables of candidates come from it
    out = None
    for kind in KINDS:
        plain = candidates(based.select("held", F.col("rest").alias("u")), kind, "u")
        plain = plain.select("held", F.explode_outer(f"cand_{kind}").alias("c"), F.lit(0.0).alias("yes"), F.lit(1.0).alias("no")).where("c IS NOT NULL")
        spans = based.select("held", F.explode_outer(f"base_{kind}").alias("x")).where("x IS NOT NULL").select("held", "x.span", "x.before", "x.after", "x.digits")
        whole = [F.struct(F.expr(e).alias("span"), F.lit(y).alias("yes"), F.lit(RESPELLED - y).alias("no"))
                 for e, y in [("span", RESPELLED), *((e, 0.0) for e in BROKEN[kind])]]
        made = spans.select("held", "before", "after", F.explode(F.array(*whole)).alias("m")).select(
            "held", "before", "after", "m.*", F.regexp_replace("m.span", "[^0-9]", "").alias("digits"))
        made = made.select("held", "before", "after", "yes", "no", F.explode(F.array(*map(F.expr, SPELLINGS[kind]))).alias("m")).select(
            "held", F.concat("before", "m", "after").alias("u"), F.length("before").alias("lo"),
            (F.length("before") + F.length("m")).alias("hi"), "yes", "no")
        made = candidates(made, kind, "u").select("held", F.explode_outer(f"cand_{kind}").alias("c"), "yes", "no", "lo", "hi")
        made = made.where("c.start < hi AND c.stop > lo").select("held", "c", "yes", "no")
        rows = plain.unionByName(made).groupBy("held", *[F.col(f"c.{n}").alias(n) for n in FEATURES]).agg(
            F.sum("yes").alias("yes"), F.sum("no").alias("no")).withColumn("kind", F.lit(kind))
        out = rows if out is None else out.unionByName(rows)
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
          precision: float = PRECISION) -> Detector:
    """A detector from a sample of about ``sample_docs`` rows, chosen by a hash of
    id and text. The distinct feature vectors of its candidates are collected."""
    rows = _rows(docs, id_col, text_col)
    every = max(1, docs.count() // sample_docs)
    sample = rows.where(F.pmod(F.xxhash64("id", "t"), F.lit(every)) == 0)
    table = sorted((r.asDict() for r in _examples(sample.select("t")).collect()), key=lambda r: [str(v) for v in r.values()])
    models = {}
    for kind in KINDS:
        mine = _likely([r for r in table if r["kind"] == kind], BY_CHANCE.get(kind))
        seen, held = ([r for r in mine if r["held"] == side] for side in (False, True))
        if not any(r["yes"] for r in seen) or not any(r["yes"] for r in held):
            continue
        model = fit(seen, FEATURES)
        cut = threshold([model.of(r) for r in held], [r["yes"] for r in held], [r["no"] for r in held], precision, LEAST_POSITIVE)
        if cut is not None:
            models[kind] = (model, cut)
    return Detector(models)


def _likely(rows: list[dict], chance: float | None) -> list[dict]:
    """Plain candidates are unlabelled. Where the check rarely passes by chance, the
    failing ones of the same vector tell how many of the passing ones are negative."""
    if chance is None:
        return rows
    key = ["held", *(f for f in FEATURES if f != "form")]
    failing = {tuple(r[k] for k in key): r["no"] for r in rows if not r["form"]}
    most = chance / (1 - chance)
    return [r | {"no": min(r["no"], failing.get(tuple(r[k] for k in key), 0.0) * most)} if r["form"] else r for r in rows]


def personal_data(docs: DataFrame, detector: Detector, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, base, added), one row a document, in the documents' order: arrays
    of (start, kind, stop, name) sorted by start, then kind. Positions count code
    points, stop is exclusive; kind is the place of name in KINDS. ``base`` are the
    checked base spans, ``added`` the candidates that the detector takes.

    Defined cases: null and empty texts have no spans; ids of any type, null ones
    and repeated rows stay as they are; texts of any length are searched whole; a
    span is one kind's, and spans of two kinds may overlap; a match that fails its
    check is dropped and nothing inside it is tried again for the base; an empty
    table gives an empty result; other columns are not looked at."""
    df = base_spans(_rows(docs, id_col, text_col), "t")
    base, added = [], []
    for n, kind in enumerate(KINDS):
        place = f"struct(x.start AS start, {n} AS kind, x.stop AS stop, '{kind}' AS name)"
        base.append(F.expr(f"transform(base_{kind}, x -> {place})"))
        if kind in detector.models:
            model, cut = detector.models[kind]
            df = candidates(df, kind, "rest")
            df = df.withColumn(f"taken_{kind}", F.expr(f"filter(cand_{kind}, x -> {model.sql('x.')} >= {cut - 1e-9:.9f}D)"))
            added.append(F.expr(f"transform(taken_{kind}, x -> {place})"))
    none = F.expr("slice(array(struct(0L AS start, 0 AS kind, 0L AS stop, '' AS name)), 1, 0)")
    # Staged: a filter on the spans would otherwise be pushed into every step that made them.
    return staged(df.select(F.col("id").alias(id_col), F.array_sort(F.concat(*base)).alias("base"),
                            F.array_sort(F.concat(*(added or [none]))).alias("added")), "spans")


def spelled(spans: Column | str) -> Column:
    """kind:start:stop of every span, joined by commas."""
    one = F.transform(spans, lambda x: F.concat_ws(":", x["name"], x["start"].cast("string"), x["stop"].cast("string")))
    return F.array_join(one, ",")
