"""Column-expression helpers (pure pyspark.sql.functions, JVM side)."""

from .exprs import is_blank, nan_to_null, null_or_nan
from .time import (
    date_attributes,
    date_key,
    epoch_nanos_to_timestamp,
    local_to_utc,
    parse_time_lenient,
    round_to_second,
    to_price,
)

__all__ = [
    "is_blank",
    "nan_to_null",
    "null_or_nan",
    "date_attributes",
    "date_key",
    "epoch_nanos_to_timestamp",
    "local_to_utc",
    "parse_time_lenient",
    "round_to_second",
    "to_price",
]
