"""Ordered per-key series operators: forward fill, row-frame moving averages,
lead targets — exact, and safe when one key holds a large share of all rows.

Two physical strategies produce identical rows (``auto`` picks one from a
measured bound, see ``pick_strategy``):

``direct``   ``Window.partitionBy(keys).orderBy(order)``: one hash exchange, but
             every row of a key lands in one task. Fine when a key's series is
             bounded (e.g. hourly bars: <= 8,784 rows per key and year).

``chunked``  (default) the series is cut into fixed-size chunks of consecutive
             rows so no task ever holds more than ``chunk_rows`` (+ halo) rows:

  1. range-partition + sort on (keys, order); the partition id and the row's
     offset inside the partition are recorded, then the sorted table is staged
     as Parquet so every later branch sees the same positions and reads only
     the columns it needs;
  2. the global position ``pos`` = rows in earlier partitions + offset (a
     broadcast table of P rows, P = partition count);
  3. ``chunk = pos div chunk_rows``. The last ``halo_before`` rows of each
     chunk are copied into the next chunk (frames reaching back) and the first
     ``halo_after`` rows into the previous one (``lead``);
  4. forward fill across chunks: a small summary (one row per key x chunk
     half), itself cut into blocks, gives the last non-null value before each
     chunk's halo for the one key that crosses it, joined on the chunk, applied
     where the (null-safe) key is that one and coalesced with the in-chunk fill;
  5. windows run over ``partitionBy(keys, chunk).orderBy(pos)``; copies are dropped.

  Rows of one key are contiguous in ``pos``, so a chunk's halo either belongs to
  the same key or is separated from it by the (keys, chunk) partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import nan_to_null
from ..session import staged

POS = "_bl_pos"
PART = "_bl_part"
HALO = "_bl_halo"
_PID = "_bl_pid"
_OFF = "_bl_off"

DEFAULT_CHUNK_ROWS = 1 << 20
#: Summary rows of one key that a task of the carry's first level orders.
CARRY_BLOCK = 4096


def _names(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def max_rows_per_key(df: DataFrame, keys) -> int:
    """Rows of the largest series (0 when empty). One aggregate; column
    pruning leaves the scan with the keys and whatever ``df``'s own filters
    read. Counts are combined map-side, so a hot key costs one partial count
    per task, and only one number reaches the driver."""
    keys = _names(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_bl_n")) if keys else df.select(
        F.count(F.lit(1)).alias("_bl_n"))
    top = per_key.agg(F.max("_bl_n")).first()[0]
    return int(top or 0)


def pick_strategy(df: DataFrame, keys, chunk_rows: int | None = None, extra_rows: int = 0) -> str:
    """``direct`` when the measured largest series of ``df`` plus ``extra_rows``
    fits in one chunk, else ``chunked``. The single-task window is thus used
    only behind a size check, like a broadcast."""
    b = chunk_rows or chunk_rows_conf(df)
    n = max_rows_per_key(df, keys) + int(extra_rows)
    return "direct" if n <= b else "chunked"


def chunk_rows_conf(df: DataFrame) -> int:
    value = df.sparkSession.conf.get("barlake.series.chunkRows", None)
    return int(value) if value else DEFAULT_CHUNK_ROWS


def with_position(df: DataFrame, keys, order, num_partitions: int | None = None) -> DataFrame:
    """Add ``_bl_pos``: 0-based global rank over (keys, order).

    Range partitioning spreads a hot key over many tasks; no single-task window.
    ``order`` must be a total order inside each key (add tie-break columns).
    """
    keys, order = _names(keys), _names(order)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pid = F.spark_partition_id()
    ranged = (
        df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in keys + order])
        .sortWithinPartitions(*keys, *order)
        .withColumn(_PID, pid)
        # documented layout: partition id in the upper 31 bits, row index below.
        .withColumn(_OFF, F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))
    )
    ranged = staged(ranged, "positions")
    sizes = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_bl_n"))
    # one row per range partition, so the global window and the broadcast are tiny
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(_PID, F.coalesce(F.sum("_bl_n").over(before), F.lit(0)).alias("_bl_start"))
    return (
        ranged.join(F.broadcast(starts), _PID)
        .withColumn(POS, F.col("_bl_start") + F.col(_OFF))
        .drop(_PID, _OFF, "_bl_start")
    )


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    """Null-safe equality of the columns: a NULL key is a series of its own."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def _fill_carry(pos_df: DataFrame, keys: list[str], fill_cols: list[str],
                chunk_rows: int, halo_before: int) -> DataFrame:
    """Per chunk p: the key whose rows cross the start of chunk p's halo (keys
    are contiguous in position, so there is one at most), and the last non-null
    value of each fill column among its rows before, i.e. at positions
    < p*chunk_rows - halo."""
    chunk = F.expr(f"{POS} div {int(chunk_rows)}")
    tail = (F.col(POS) % chunk_rows) >= (chunk_rows - halo_before)
    region = (chunk * 2 + tail.cast("long")).alias("_bl_region")
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(POS))).alias(c) for c in fill_cols]
    summary = pos_df.groupBy(*keys, region).agg(F.max(POS).alias("_bl_last"), *aggs)
    block = F.expr(f"_bl_region div {CARRY_BLOCK}").alias("_bl_block")
    summary = staged(summary.select("*", block), "carry")
    upto = Window.partitionBy(*keys, "_bl_block").orderBy("_bl_region").rowsBetween(Window.unboundedPreceding, 0)
    cum = summary.select(
        *keys, "_bl_region", "_bl_block", "_bl_last",
        *[F.last(c, ignorenulls=True).over(upto).alias(f"_bl_carry_{c}") for c in fill_cols],
    )
    # second level: what the key's earlier blocks leave behind, one row a block
    blocks = summary.groupBy(*keys, "_bl_block").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_bl_region"))).alias(c) for c in fill_cols])
    earlier = Window.partitionBy(*keys).orderBy("_bl_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*keys, "_bl_block", *[F.last(c, ignorenulls=True).over(earlier).alias(f"_bl_before_{c}") for c in fill_cols])
    cum = cum.join(blocks, _same(cum, blocks, [*keys, "_bl_block"]), "left").select(
        *[cum[k] for k in keys], "_bl_region", "_bl_last",
        *[F.coalesce(f"_bl_carry_{c}", f"_bl_before_{c}").alias(f"_bl_carry_{c}") for c in fill_cols])
    # region 2(p-1) (head of chunk p-1) ends right before chunk p's halo; its
    # last row belongs to the crossing key.
    row = F.struct(*[F.col(k).alias(f"_bl_key_{k}") for k in keys], *[f"_bl_carry_{c}" for c in fill_cols])
    heads = cum.filter(F.col("_bl_region") % 2 == 0)
    return heads.groupBy((F.expr("_bl_region div 2") + 1).alias(PART)).agg(
        F.max_by(row, "_bl_last").alias("row")).select(PART, "row.*")


def _with_copies(pos_df: DataFrame, b: int, halo_before: int, halo_after: int) -> DataFrame:
    """Each row tagged with its chunk (``PART``), plus halo copies: the last
    ``halo_before`` rows of a chunk into the next, the first ``halo_after``
    into the previous one (``HALO`` = True)."""
    chunk = F.expr(f"{POS} div {int(b)}")
    offset = F.col(POS) % b
    copies = [F.struct(chunk.alias("p"), F.lit(False).alias("h"))]
    if halo_before:
        copies.append(F.when(offset >= b - halo_before, F.struct((chunk + 1).alias("p"), F.lit(True).alias("h"))))
    if halo_after:
        copies.append(F.when((offset < halo_after) & (chunk > 0),
                             F.struct((chunk - 1).alias("p"), F.lit(True).alias("h"))))
    exploded = pos_df.select("*", F.explode(F.filter(F.array(*copies), lambda x: x.isNotNull())).alias("_bl_copy"))
    return exploded.select(
        *[c for c in pos_df.columns], F.col("_bl_copy.p").alias(PART), F.col("_bl_copy.h").alias(HALO)
    )


def chunk_layout(df: DataFrame, keys, order, chunk_rows: int, halo_before: int = 0,
                 halo_after: int = 0) -> DataFrame:
    """Rows per window partition (keys, chunk) of the chunked strategy, halo
    copies included: the unit of work of one task. Inspection helper."""
    keys, order = _names(keys), _names(order)
    pos_df = with_position(df, keys, order)
    return _with_copies(pos_df, chunk_rows, halo_before, halo_after).groupBy(*keys, PART).agg(
        F.count(F.lit(1)).alias("rows"))


def series_windows(
    df: DataFrame,
    keys,
    order,
    fill_cols: Sequence[str] = (),
    build=None,
    halo_before: int = 0,
    halo_after: int = 0,
    strategy: str = "chunked",
    chunk_rows: int | None = None,
    nan_as_null: bool = True,
) -> DataFrame:
    """Forward-fill ``fill_cols`` (last non-null, unbounded preceding) and then
    add the columns returned by ``build(window_spec) -> list[Column]`` which may
    reference the filled columns (several such functions: one after the other,
    columns named ``_bl_*`` being theirs alone); frames may reach ``halo_before`` rows back and
    ``halo_after`` rows ahead. ``strategy``: ``chunked``, ``direct`` or
    ``auto`` (direct only if the largest series is measured to fit one chunk)."""
    keys, order, fill_cols = _names(keys), _names(order), list(fill_cols)
    if strategy == "auto":
        strategy = pick_strategy(df, keys, chunk_rows)
    if nan_as_null and fill_cols:
        floats = {c for c, kind in df.dtypes if c in fill_cols and kind in ("float", "double")}
        df = df.select(*[nan_to_null(c).alias(c) if c in floats else F.col(c) for c in df.columns])
    cols = df.columns

    def apply(frame: DataFrame, spec: Window, carry: list[Column] | None) -> DataFrame:
        upto = spec.rowsBetween(Window.unboundedPreceding, 0)
        if fill_cols:
            filled = []
            for i, c in enumerate(fill_cols):
                e = F.last(c, ignorenulls=True).over(upto)
                if carry is not None:
                    e = F.coalesce(e, carry[i])
                filled.append(e.alias(c))
            frame = frame.select(*[c for c in frame.columns if c not in fill_cols], *filled)
        for step in build if isinstance(build, (list, tuple)) else [build] if build else []:
            frame = frame.select("*", *step(spec))  # a later step may use an earlier one's columns
        return frame

    if strategy == "direct":
        spec = Window.partitionBy(*keys).orderBy(*order)
        out = apply(df, spec, None)
        extra_names = [c for c in out.columns if c not in cols and not c.startswith("_bl_")]
        return out.select(*cols, *extra_names)

    if strategy != "chunked":
        raise ValueError(f"unknown strategy {strategy!r}")
    b = chunk_rows or chunk_rows_conf(df)
    if b <= max(halo_before, halo_after):
        raise ValueError("chunk_rows must exceed the frame reach")
    pos_df = with_position(df, keys, order)
    exploded = _with_copies(pos_df, b, halo_before, halo_after)
    carry_cols = None
    if fill_cols:
        # joined on the chunk alone: the windows below reuse that partitioning
        exploded = exploded.join(_fill_carry(pos_df, keys, fill_cols, b, halo_before), PART, "left")
        crossing = F.lit(True)
        for k in keys:
            crossing = crossing & F.col(k).eqNullSafe(F.col(f"_bl_key_{k}"))
        carry_cols = [F.when(crossing, F.col(f"_bl_carry_{c}")) for c in fill_cols]
    spec = Window.partitionBy(*keys, PART).orderBy(POS)
    out = apply(exploded, spec, carry_cols).filter(~F.col(HALO))
    extra_names = [c for c in out.columns if c not in cols and not c.startswith("_bl_")]
    return out.select(*cols, *extra_names)


def forward_fill(df: DataFrame, keys, order, cols, **kw) -> DataFrame:
    """Last non-null value per key up to the current row (NaN treated as NULL
    unless ``nan_as_null=False``)."""
    return series_windows(df, keys, order, fill_cols=_names(cols), **kw)


def moving_average_columns(col: str, windows=(10, 20, 50, 200), prefix: str = "ma"):
    def build(spec: Window) -> list[Column]:
        return [F.avg(col).over(spec.rowsBetween(-(n - 1), 0)).alias(f"{prefix}{n}") for n in windows]
    return build


#: Prefix sums: decimals of a value, and the bound of its magnitude. A sum of 10^10
#: such values fits a decimal(38).
PREFIX_SCALE, PREFIX_LIMIT = 15, 10**13


def prefix_average_columns(col: str, windows=(10, 20, 50, 200), prefix: str = "ma"):
    """Averages over row frames by differences of prefix sums: one decimal addition
    a row whatever the frames are, and exact where a frame's double additions drift.
    A chunk's sums begin at its halo, whose first row no frame of the chunk
    outreaches, so they need no carry."""
    c = F.col(col)
    value = F.when(c.isNotNull() & ~(F.abs(c) < PREFIX_LIMIT), F.raise_error(F.lit(f"{col}: prefix sums take finite values below {PREFIX_LIMIT}"))).otherwise(
        c.cast(f"decimal(28,{PREFIX_SCALE})"))

    def sums(spec: Window) -> list[Column]:
        upto = spec.rowsBetween(Window.unboundedPreceding, 0)
        return [F.sum(value).over(upto).alias("_bl_sum"), F.count(c).over(upto).alias("_bl_n")]

    def differences(spec: Window) -> list[Column]:
        out = []
        for n in windows:
            before = [F.coalesce(F.lag(x, n).over(spec), F.lit(0)) for x in ("_bl_sum", "_bl_n")]
            total, count = F.coalesce(F.col("_bl_sum"), F.lit(0)) - before[0], F.col("_bl_n") - before[1]
            out.append(F.when(count > 0, total.cast("double") / count).alias(f"{prefix}{n}"))
        return out

    return [sums, differences]


def rolling_mean(df: DataFrame, keys, order, col: str, windows=(10, 20, 50, 200),
                 prefix: str = "ma", method: str = "frame", **kw) -> DataFrame:
    """Mean of the last n rows (partial at series start, NULL-skipping). ``frame``
    adds up every frame (NaN spreads); ``prefix`` takes :func:`prefix_average_columns`,
    an error for values that are not finite or too large."""
    if method == "prefix":
        return series_windows(df, keys, order, build=prefix_average_columns(col, windows, prefix), halo_before=max(windows) - 1, **kw)
    if method != "frame":
        raise ValueError(f"unknown method {method!r}")
    return series_windows(df, keys, order, build=moving_average_columns(col, windows, prefix),
                          halo_before=max(windows) - 1, **kw)


def lead_target(df: DataFrame, keys, order, col: str, name: str = "target_next", **kw) -> DataFrame:
    """Value of ``col`` on the next row of the same series (NULL on the last)."""
    def build(spec: Window) -> list[Column]:
        return [F.lead(col).over(spec).alias(name)]
    return series_windows(df, keys, order, build=build, halo_after=1, **kw)
