"""Declarative table constraints (PK/UNIQUE, NOT NULL, FK) checked as
distributed aggregates and anti-joins; one result row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_constraints(
    df: DataFrame,
    name: str,
    pk: Sequence[str] = (),
    not_null: Sequence[str] = (),
    fks: Mapping[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """Rows (table, check, violations). FK checks first reduce the child to
    (value, row count) with a partial aggregation — a hot foreign-key value
    leaves each task as one row — then left-anti join the referenced key set
    (distinct) and sum the counts of the orphans."""
    parts = []
    checks = [("not_null:" + c, c) for c in not_null]
    if pk or not_null:
        # one scan: rows and NULLs per key, then the sums
        nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(not_null)]
        if pk:
            per_key = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("_n"), *nulls)
            sums = [F.count_if(F.col("_n") > 1).alias("_pk"),
                    *[F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(f"_null_{i}") for i in range(len(checks))]]
            totals = per_key.agg(*sums)
        else:
            totals = df.agg(*nulls)
        found = [F.struct(F.lit("pk:" + ",".join(pk)).alias("check_name"), F.col("_pk").alias("violations"))] if pk else []
        found += [F.struct(F.lit(label).alias("check_name"), F.col(f"_null_{i}").alias("violations")) for i, (label, _) in enumerate(checks)]
        parts.append(totals.select(F.lit(name).alias("table_name"), F.inline(F.array(*found))))
    for col, (ref, ref_col) in (fks or {}).items():
        keys = ref.select(F.col(ref_col).alias(col)).distinct()
        values = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
        orphans = values.join(keys, col, "left_anti")
        parts.append(orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")).select(
            F.lit(name).alias("table_name"), F.lit(f"fk:{col}").alias("check_name"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "check_name", F.col("violations").cast("long"))


class ConstraintError(ValueError):
    """A table that would break its declared constraints."""


def enforce_constraints(checks: DataFrame) -> None:
    """Raise once, naming every violated check (a bounded list: one row each)."""
    broken = checks.where("violations > 0").orderBy("table_name", "check_name").collect()
    if broken:
        raise ConstraintError("; ".join(f"{r.table_name} {r.check_name}: {r.violations}" for r in broken))
