"""Schema normalisation, key cleaning, time-window filters and
deterministic de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import is_blank


def require_columns(df: DataFrame, names) -> None:
    """Raise if any of ``names`` is missing (run before the normalising select).
    Case does not matter, as in Spark's own name resolution."""
    there = {c.lower() for c in df.columns}
    missing = sorted(n for n in set(names) if n.lower() not in there)
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def normalize_schema(df: DataFrame, mapping: Mapping[str, tuple[str, str]],
                     upper: Sequence[str] = ()) -> DataFrame:
    """``mapping``: target name -> (source column, target type). Checks the
    source columns first, then one select (pruned and pushed to the scan)."""
    require_columns(df, [src for src, _ in mapping.values()])
    cols = []
    for name, (src, dtype) in mapping.items():
        c = F.col(src).cast(dtype)
        if name in upper:
            c = F.upper(c)
        cols.append(c.alias(name))
    return df.select(*cols)


def capitalize_columns(df: DataFrame) -> DataFrame:
    """Vendor column-case normalisation (``time`` -> ``Time``)."""
    return df.toDF(*[c[:1].upper() + c[1:].lower() for c in df.columns])


def clean_keys(df: DataFrame, keys, time: str | None = None,
               defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Drop rows whose key is NULL/blank (or whose time is NULL); default
    measures (e.g. volume NULL -> 0)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cond = None
    for k in keys:
        ok = ~is_blank(F.col(k))
        cond = ok if cond is None else cond & ok
    if time:
        cond = cond & F.col(time).isNotNull()
    out = df.filter(cond)
    if defaults:
        out = out.select(*[
            F.coalesce(F.col(c), F.lit(defaults[c]).cast(dict(df.dtypes)[c])).alias(c) if c in defaults else F.col(c)
            for c in df.columns
        ])
    return out


def filter_time_window(df: DataFrame, time: str, lo=None, hi=None, hi_inclusive_day: bool = True) -> DataFrame:
    """Half-open [lo, hi + 1 day) on a timestamp (or [lo, hi) when
    ``hi_inclusive_day`` is False). Bounds are literals, so Parquet row groups
    are skipped by min/max statistics."""
    t = F.col(time)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (t >= F.lit(str(lo)).cast("timestamp_ntz"))
    if hi is not None:
        upper = F.lit(str(hi)).cast("timestamp_ntz")
        if hi_inclusive_day:
            upper = F.date_add(F.lit(str(hi)).cast("date"), 1).cast("timestamp_ntz")
        cond = cond & (t < upper)
    return df.filter(cond)


def dedupe_keep_last(df: DataFrame, keys, order: Sequence[Column | str]) -> DataFrame:
    """Keep one row per key: the last by ``order`` (a list of columns, all
    compared descending; give enough tie-breakers for a total order).

    ``row_number() == 1`` is planned as WindowGroupLimit(Partial) -> Exchange
    -> WindowGroupLimit(Final): every map task forwards at most one row per
    key, so a hot key costs no more shuffle than any other (and all columns
    stay in Tungsten rows, unlike a max(struct) aggregate that falls back to
    sort-based aggregation)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    spec = Window.partitionBy(*keys).orderBy(*[
        (F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order
    ])
    return df.withColumn("_bl_rn", F.row_number().over(spec)).filter("_bl_rn = 1").drop("_bl_rn")


def universe_filter(listing: DataFrame, symbol: str, conditions: Mapping[str, object]) -> DataFrame:
    """Distinct non-null symbols whose attributes equal ``conditions``."""
    cond = F.lit(True)
    for c, v in conditions.items():
        cond = cond & (F.col(c) == F.lit(v))
    return listing.filter(cond).select(symbol).na.drop().distinct()


def row_sample(df: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows by ``order`` for a look at a table; planned as a
    top-n, so each task forwards at most ``n`` rows."""
    return df.orderBy(*order).limit(n)
