from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL so that NULL-skipping fills and averages also skip NaN. For
    float and double columns; the type stays."""
    col = _c(c)
    return F.when(~F.isnan(col), col)


def null_or_nan(c) -> Column:
    col = _c(c)
    return col.isNull() | F.isnan(col)


def is_blank(c) -> Column:
    """NULL, empty or whitespace-only string."""
    col = _c(c)
    return col.isNull() | (F.length(F.trim(col)) == 0)


def combine_one_row(*frames):
    """Several one-row aggregates with distinct column names -> one row
    (union of the rows, then a global max per column; no join)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])
