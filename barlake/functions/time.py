"""Time handling. Everything stays TIMESTAMP_NTZ (wall clock) so results do
not depend on the session time zone; zones are explicit parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, TimestampNTZType, TimestampType


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_nanos_to_timestamp(c, data_type=LongType()) -> Column:
    """Naive nanosecond wall clock (INT64) -> TIMESTAMP_NTZ.

    Integer division keeps sub-microsecond tails from rounding up into the
    next microsecond/second (``x / 1000`` is a double division). Columns that
    already arrive as timestamps (µs files) are passed through as NTZ.
    """
    col = _c(c)
    if isinstance(data_type, TimestampNTZType):
        return col
    if isinstance(data_type, TimestampType):
        return col.cast("timestamp_ntz")
    return ntz_from_micros(F.floor(col.cast("decimal(20,0)") / F.lit(1000)).cast("long"))


def ntz_from_micros(micros) -> Column:
    """Epoch microseconds -> NTZ wall clock, independent of the session zone."""
    secs = _c(micros).cast("decimal(20,0)") / F.lit(1000000)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=secs.cast("decimal(18,6)")
    )


def local_to_utc(c, zone: str) -> Column:
    """Wall clock in ``zone`` (NTZ) -> wall clock in UTC (NTZ)."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), _c(c))


def round_to_second(c) -> Column:
    """DATETIME2(0)-style rounding (half up) of an NTZ timestamp."""
    shifted = _c(c) + F.expr("INTERVAL '0.5' SECOND")
    return F.date_trunc("second", shifted).cast("timestamp_ntz")


def parse_time_lenient(c, fmt: str | None = None) -> Column:
    """String -> NTZ, unparseable -> NULL (never raises, ANSI or not)."""
    col = _c(c)
    if fmt:
        return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")
    return F.try_to_timestamp(col).cast("timestamp_ntz")


def to_price(c, scale: int = 4) -> Column:
    """double -> decimal(19, scale), HALF_UP. The double is first rounded to 9
    decimals (exactly representable in decimal(38,9)) so floating-point noise
    from differently ordered sums cannot flip a half-way tie at ``scale``."""
    return F.round(_c(c), 9).cast("decimal(38,9)").cast(f"decimal(19,{scale})")


def utc_now_second() -> str:
    """Run timestamp (UTC, floored to the second) to pass into a job as a
    literal, so every task and rerun sees the same value."""
    import datetime as _dt

    now = _dt.datetime.now(_dt.timezone.utc).replace(microsecond=0, tzinfo=None)
    return now.strftime("%Y-%m-%d %H:%M:%S")


def date_key(c) -> Column:
    """yyyymmdd integer key of a date/timestamp."""
    d = F.to_date(_c(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_attributes(c) -> list[Column]:
    """Calendar attributes of ``dim_date`` (Sunday=1 ... Saturday=7)."""
    d = F.to_date(_c(c))
    dow = F.dayofweek(d)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("smallint").alias("year"),
        F.quarter(d).cast("tinyint").alias("quarter"),
        F.month(d).cast("tinyint").alias("month"),
        F.dayofmonth(d).cast("tinyint").alias("day"),
        dow.cast("tinyint").alias("day_of_week"),
        dow.isin(1, 7).alias("is_weekend"),
    ]
