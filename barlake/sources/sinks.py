"""Parquet sinks: bronze landing, full/incremental publish, append, and a
staged overwrite for read-modify-write of the same dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


MAX_RECORDS_PER_FILE = 4_000_000


def _write(df: DataFrame, path: str, partition_by: Sequence[str], mode: str, overwrite_mode: str | None,
           sort_by: Sequence[str] = (), cluster: str = "range", bloom: Sequence[str] = ()) -> None:
    """``range``: range partitioning on (partition columns, sort columns) —
    each task writes a contiguous slice, a directory gets few files, and a
    huge partition value (one day holding a third of the data) is split over
    many tasks by sampled bounds; the sampling pass reads the input once more,
    so callers pass materialised frames. ``hash``: one task per partition value
    tuple, no sampling pass — for partition values whose size is bounded by
    construction (a bar table's (day, key): at most one row per interval)."""
    partition_by, sort_by = list(partition_by), list(sort_by)
    if partition_by or sort_by:
        if cluster == "hash" and partition_by:
            df = df.repartition(*[F.col(c) for c in partition_by])
        else:
            df = df.repartitionByRange(*[F.col(c) for c in partition_by + sort_by])
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    w = df.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    for c in bloom:  # for row groups whose dictionary is too large to skip by
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if overwrite_mode:
        w = w.option("partitionOverwriteMode", overwrite_mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "full",
            sort_by: Sequence[str] = (), bloom: Sequence[str] = ()) -> None:
    """``full``: static overwrite — the dataset is rebuilt and stale partitions
    disappear. ``incremental``: dynamic overwrite — only partitions present in
    ``df`` are replaced. The option is per write, never session-wide.
    ``df`` must not read ``path`` itself (use :func:`staged_overwrite`).
    ``bloom``: columns with Parquet Bloom filters, a second access path."""
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown publish mode {mode!r}")
    _write(df, path, partition_by, "overwrite", "static" if mode == "full" else "dynamic", sort_by, bloom=bloom)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _write(df, path, partition_by, "append", None)


def staged_overwrite(df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> None:
    """Dynamic overwrite of ``path`` with a ``df`` that may read ``path``:
    materialise to a fresh staging folder in the shared work dir first, then
    overwrite from the staged copy (never overwrite a path being read)."""
    spark = df.sparkSession
    stage = scratch_path(spark, "stage")
    df.write.mode("overwrite").parquet(stage)
    publish(spark.read.parquet(stage), path, partition_by, mode="incremental", sort_by=sort_by)


def land_bronze(df: DataFrame, path: str, key: str = "Ticker", time: str = "Time",
                date_col: str = "Trade_date", delivery_order: Sequence[str] = (),
                cluster: str = "hash") -> None:
    """Bronze landing partitioned by (date, key), rows sorted by time. With
    ``delivery_order`` (e.g. a fetch sequence column) rows are first
    de-duplicated on (key, time), keeping the last delivered one, and those
    columns are dropped. Re-landing a (date, key) replaces just that
    partition (dynamic overwrite). ``cluster="hash"`` suits bars (a (day, key)
    holds at most one row per interval); raw ticks, where one (day, key) may be
    huge, use ``cluster="range"``."""
    if delivery_order:
        from ..operators.clean import dedupe_keep_last

        df = dedupe_keep_last(df, [key, time], list(delivery_order)).drop(*delivery_order)
    _write(df, path, [date_col, key], "overwrite", "dynamic", [time], cluster=cluster)
