"""MERGE-style upsert and surrogate keys on plain DataFrames.

The match join is a full outer join on the natural key. Both sides are unique
on that key (callers de-duplicate first), so no key can be hot in the join."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

Expr = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    on_match: Mapping[str, Expr] | None = None,
    on_insert: Mapping[str, Expr] | None = None,
    action_col: str | None = None,
) -> DataFrame:
    """New target = target rows not in source, unchanged
                  + matched rows, updated (source value, or ``on_match[c](t, s)``)
                  + source-only rows, inserted (source value, or ``on_insert[c](t, s)``).

    Nothing is deleted (no WHEN NOT MATCHED BY SOURCE). ``t(c)``/``s(c)`` in
    the callables address the target/source column ``c``. The output keeps the
    target schema; ``action_col`` optionally adds 'keep'/'update'/'insert'.
    """
    keys = list(keys)
    on_match = dict(on_match or {})
    on_insert = dict(on_insert or {})
    tcols = [c for c in target.columns if c not in keys]
    scols = set(source.columns) - set(keys)

    def t(c: str) -> Column:
        return F.col(f"_t_{c}")

    def s(c: str) -> Column:
        return F.col(f"_s_{c}")

    tt = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in tcols], F.lit(True).alias("_t_hit"))
    ss = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in sorted(scols)], F.lit(True).alias("_s_hit"))
    j = tt.join(ss, keys, "full_outer")
    matched = F.col("_t_hit").isNotNull() & F.col("_s_hit").isNotNull()
    only_s = F.col("_t_hit").isNull()
    dtypes = dict(target.dtypes)
    out = [F.col(k) for k in keys]
    for c in tcols:
        upd = on_match[c](t, s) if c in on_match else (s(c) if c in scols else t(c))
        ins = on_insert[c](t, s) if c in on_insert else (s(c) if c in scols else F.lit(None))
        out.append(
            F.when(matched, upd).when(only_s, ins).otherwise(t(c)).cast(dtypes[c]).alias(c)
        )
    if action_col:
        out.append(F.when(matched, "update").when(only_s, "insert").otherwise("keep").alias(action_col))
    return j.select(*out)


def number_rows(df: DataFrame, key: str, first: int) -> DataFrame:
    """``df`` with ``key``: first, first + 1, ... without gaps. Every partition takes
    a range as long as itself; no sort and no shuffle, whatever the size. The rows
    are staged, so a lost executor cannot number them differently."""
    pid = F.spark_partition_id()
    rows = staged(df.withColumn("_bl_pid", pid).withColumn("_bl_off", F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)), "numbered")
    sizes = rows.groupBy("_bl_pid").agg(F.count(F.lit(1)).alias("_bl_n"))
    # one row per partition: the window and the broadcast are tiny
    before = Window.orderBy("_bl_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bl_pid", (F.coalesce(F.sum("_bl_n").over(before), F.lit(0)) + first).alias("_bl_start"))
    out = rows.join(F.broadcast(starts), "_bl_pid").withColumn(key, F.col("_bl_start") + F.col("_bl_off"))
    return out.drop("_bl_pid", "_bl_off", "_bl_start")


def assign_keys(existing: DataFrame | None, members: DataFrame, natural: Sequence[str] | str,
                key: str) -> DataFrame:
    """Surrogate keys: existing members keep theirs; new members (left anti
    join) get max(existing) + 1, + 2, ... in natural-key order.

    Numbering uses the distributed global rank (range partitioning + per
    partition offsets), never a single-partition window."""
    from .series import POS, with_position

    natural = [natural] if isinstance(natural, str) else list(natural)
    members = members.select(*natural).na.drop().distinct()
    if existing is None:
        new = members
        base = F.lit(0).cast("long")
        kept = None
    else:
        new = members.join(existing.select(*natural), natural, "left_anti")
        top = existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).first()[0]  # one number
        base = F.lit(top).cast("long")
        kept = existing.select(*natural, F.col(key).cast("long").alias(key))
    if kept is not None and new.isEmpty():  # steady state: no new member, no ranking job
        return kept
    ranked = with_position(new, [], natural)
    fresh = ranked.select(*natural, (base + F.col(POS) + 1).cast("long").alias(key))
    return fresh if kept is None else kept.unionByName(fresh)
