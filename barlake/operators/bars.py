"""Fixed-interval OHLCV bars from ticks/events (the vendor's 1-hour bars,
rebuilt on Spark). A groupBy with map-side partial aggregation, so a hot key
is pre-aggregated per task before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTEGERS = ("tinyint", "smallint", "int", "bigint")


def order_key(df: DataFrame, time: str, tie_break: Sequence[str]) -> Column:
    """A total order by (time, *tie_break). Time and one integer tie-break are
    packed into a decimal(38,0), which hash aggregation can update in place; a
    struct would make every map task sort its raw ticks."""
    kinds = dict(df.dtypes)
    if kinds[time] not in ("timestamp", "timestamp_ntz") or len(tie_break) > 1 or any(kinds[c] not in INTEGERS for c in tie_break):
        return F.struct(F.col(time), *[F.col(c) for c in tie_break])
    if kinds[time] == "timestamp":
        micros = F.unix_micros(F.col(time))
    else:  # from the wall clock's own fields: no zone, so no daylight-saving fold
        seconds = F.unix_date(F.to_date(time)).cast("long") * 86400 + F.hour(time) * 3600 + F.minute(time) * 60
        micros = seconds * 1_000_000 + (F.extract(F.lit("SECOND"), F.col(time)) * 1_000_000).cast("long")
    micros = micros.cast("decimal(18,0)")
    if not tie_break:
        return micros
    # twice the range of a bigint, so a tie-break never reaches the next microsecond
    # and a null, which comes first like in a struct, lies below it
    tie = F.coalesce(F.col(tie_break[0]).cast("decimal(19,0)"), F.lit("-9300000000000000000").cast("decimal(19,0)"))
    packed = micros * F.lit("20000000000000000000").cast("decimal(20,0)") + tie
    return packed.cast("decimal(38,0)")


def build_bars(
    df: DataFrame,
    keys,
    time: str,
    price: str,
    volume: str | None = None,
    interval: str = "1 hour",
    tie_break=(),
    bar_time: str = "bar_time",
) -> DataFrame:
    """One row per (keys, interval start): open/high/low/close of ``price`` and
    the sum of ``volume`` (row count when ``volume`` is None).

    open/close are the first/last price by (time, *tie_break) - a total order,
    so ties on ``time`` are resolved deterministically; see :func:`order_key`.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = order_key(df, time, list(tie_break))
    vol = F.count(F.lit(1)) if volume is None else F.sum(F.col(volume))
    return (
        df.groupBy(*keys, F.window(time, interval).start.alias(bar_time))
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            vol.cast("long").alias("volume"),
        )
    )
