"""Silver layer: bronze bars -> clean, forward-filled bars with moving
averages, a quality report and a hard gate; full or incremental publish."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import nan_to_null
from ..functions.time import epoch_nanos_to_timestamp, local_to_utc
from ..operators.clean import capitalize_columns, clean_keys, require_columns
from ..operators.quality import enforce, quality_metrics, report_row, write_report
from ..operators.series import moving_average_columns, pick_strategy, series_windows
from ..session import staged, staging_scope
from ..sources.scan import dataset_exists, day_folders, read_window, scan_partitioned
from ..sources.versions import Change, apply_pending, publish_together
from .series_state import KEEP_DAYS, context, day, horizon_of, last_rows, read_state, state_path, trimmed
from .windows import EmptyWindow

OHLC = ("open", "high", "low", "close")
MA_WINDOWS = (10, 20, 50, 200)
BRONZE_COLUMNS = ("Ticker", "Time", "Open", "High", "Low", "Close", "Volume")


def normalize_bronze(df: DataFrame, zone: str = "Asia/Ho_Chi_Minh") -> DataFrame:
    """Bronze (vendor columns, naive local time as ns INT64 or µs timestamp)
    -> canonical columns; event_time in UTC (NTZ), trade_date = local date."""
    df = capitalize_columns(df)
    require_columns(df, BRONZE_COLUMNS)
    local = epoch_nanos_to_timestamp("Time", dict((f.name, f.dataType) for f in df.schema.fields)["Time"])
    return df.select(
        F.col("Ticker").cast("string").alias("ticker"),
        local_to_utc(local, zone).alias("event_time"),
        F.to_date(local).alias("trade_date"),
        *[F.col(c.capitalize()).cast("double").alias(c) for c in OHLC],
        F.col("Volume").cast("long").alias("volume"),
    )


def read_bronze(spark: SparkSession, root: str, lo=None, hi=None) -> DataFrame:
    """Landed bars, all of them or those of a window of days; EmptyWindow if
    there are none. Keys are strings whatever their folder names look like, and
    nanosecond times are read as their integer (a session setting, as Spark has
    no per-read option for it)."""
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    keys = {"ticker": "string"}
    if lo is not None or hi is not None:
        return read_window(spark, root, "trade_date", lo, hi, types=keys)
    if not dataset_exists(spark, root):
        raise EmptyWindow(f"no bronze data at {root}")
    return scan_partitioned(spark, root, types=keys)


def enrich_all(df: DataFrame, key: str = "ticker", time: str = "event_time", windows=MA_WINDOWS,
               strategy: str = "auto", chunk_rows: int | None = None, nan_as_null: bool = True,
               tie_break: Sequence[str] = ()) -> DataFrame:
    """Clean keys, default volume, forward-fill OHLC and moving averages of the
    filled close, in one ordered pass. Rows before a series has had all of its
    prices are still there (see :func:`complete`).

    Silver rows are bars: a key has at most one per interval, so a series is
    usually bounded by its time span (<= 8,784 hourly bars per key and year)
    however skewed the raw rows were. ``auto`` does not rely on that: it
    measures the largest series (one partial-count aggregate over the key
    column) and runs the one-exchange ``direct`` window only if it fits one
    chunk (``barlake.series.chunkRows``); otherwise the skew-safe ``chunked``
    strategy splits every long series over many tasks."""
    cleaned = clean_keys(df, key, time, defaults={"volume": 0})
    return series_windows(
        cleaned, [key], [time, *tie_break], fill_cols=OHLC,
        build=moving_average_columns("close", windows), halo_before=max(windows) - 1,
        strategy=strategy, chunk_rows=chunk_rows, nan_as_null=nan_as_null,
    )


def complete():
    """Every price is there."""
    cond = F.lit(True)
    for c in OHLC:
        cond = cond & F.col(c).isNotNull() & ~F.isnan(c)
    return cond


def enrich(df: DataFrame, *args, **kw) -> DataFrame:
    """:func:`enrich_all` without the rows that still lack a price."""
    return enrich_all(df, *args, **kw).where(complete())


def carry_context(silver: DataFrame, before: dt.date, key: str = "ticker", time: str = "event_time",
                  rows: int = max(MA_WINDOWS) - 1, lookback_days: int | None = 45,
                  keys: DataFrame | None = None) -> DataFrame:
    """Last ``rows`` published rows per key strictly before ``before``: enough
    context for the widest frame, so incremental == full.

    Bounded read: only the ``lookback_days`` partitions before ``before`` are
    scanned (partition pruning). Keys of the new batch (``keys``) that have
    fewer than ``rows`` rows there (new or sparse series) take their context
    from the whole history by a semi join. The list of such keys is staged
    first; when it is empty, the history is not scanned.
    ``row_number() <= rows`` is planned with a partial WindowGroupLimit: each
    task keeps only its top rows per key before the shuffle.
    ``lookback_days=None`` reads the whole history."""
    history = silver.filter(F.col("trade_date") < F.lit(str(before)).cast("date"))
    if lookback_days is not None:
        lo = F.lit(str(before - dt.timedelta(days=int(lookback_days)))).cast("date")
        ranged = history.filter(F.col("trade_date") >= lo)
        wanted = (keys if keys is not None else ranged).select(key).distinct()
        counts = ranged.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        short = staged(wanted.join(counts, key, "left").filter(F.coalesce(F.col("_n"), F.lit(0)) < rows).select(key), "short_keys")
        deep = history.join(short, key, "left_semi")
        history = ranged if short.isEmpty() else ranged.join(short, key, "left_anti").unionByName(deep)
    spec = Window.partitionBy(key).orderBy(F.col(time).desc())
    return (
        history.withColumn("_bl_rn", F.row_number().over(spec))
        .filter(F.col("_bl_rn") <= rows)
        .drop("_bl_rn")
    )


def incremental_all(new_rows: DataFrame, history: DataFrame, from_date: dt.date, key: str = "ticker",
                    time: str = "event_time", windows=MA_WINDOWS, lookback_days: int | None = 45,
                    leading: DataFrame | None = None, **kw) -> DataFrame:
    """Rows with trade_date >= ``from_date``, complete or not, from the new bars
    of those days plus the carried history before them: published silver and
    ``leading``, the rows that silver left out because a price had never been
    seen. Those count in frames and carry the prices that were there, so the
    result equals a full rebuild."""
    cols = [key, time, "trade_date", *OHLC, "volume"]
    past = history.select(*cols)
    if leading is not None:
        past = past.unionByName(leading.select(*cols))
    ctx = carry_context(past, from_date, key, time, max(windows) - 1, lookback_days,
                        keys=new_rows.select(key))
    if kw.get("strategy", "auto") == "auto":
        # bound without evaluating the context twice: a key's series here is
        # its new bars plus at most max(windows) - 1 carried rows.
        kw["strategy"] = pick_strategy(new_rows, [key], kw.get("chunk_rows"), extra_rows=max(windows) - 1)
    out = enrich_all(ctx.unionByName(new_rows.select(*cols)), key, time, windows, **kw)
    return out.filter(F.col("trade_date") >= F.lit(str(from_date)).cast("date"))


def incremental(*args, **kw) -> DataFrame:
    """:func:`incremental_all` without the rows that still lack a price."""
    return incremental_all(*args, **kw).where(complete())


def leading_path(silver_path: str) -> str:
    """Rows that silver leaves out: those before a series has had all prices."""
    return f"{silver_path.rstrip('/')}_leading"


_COLUMNS = ["ticker", "event_time", *OHLC, "volume", *[f"ma{n}" for n in MA_WINDOWS], "trade_date"]
#: What a later row is computed from.
_CONTEXT = ["ticker", "event_time", "trade_date", *OHLC, "volume"]
_BACK = max(MA_WINDOWS) - 1


def _days(df: DataFrame) -> set[dt.date]:
    """Distinct trade dates, which the calendar bounds."""
    return {r[0] for r in df.select("trade_date").distinct().collect()}


def _folders(spark: SparkSession, path: str, days) -> list[str]:
    """The existing day folders of ``days``."""
    wanted = {str(d) for d in days}
    return [f for f in day_folders(spark, path, "trade_date") if f.rsplit("=", 1)[1] in wanted]


def _published(spark: SparkSession, silver_path: str, columns) -> DataFrame | None:
    """Silver and the rows it leaves out; None if neither has a day."""
    parts = [scan_partitioned(spark, path, types={"ticker": "string"}).select(*columns)
             for path in (silver_path, leading_path(silver_path)) if day_folders(spark, path, "trade_date")]
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else None


def _context(spark: SparkSession, silver_path: str, state: DataFrame | None, before: dt.date, keys: DataFrame,
             lookback_days: int | None) -> DataFrame | None:
    """What ``keys`` need to go on at the day ``before``: from the state, or from the
    history if there is no state or it does not reach back so far; None if nothing
    is published."""
    horizon = horizon_of(state)
    if horizon is not None and before >= horizon:
        return context(state.join(keys.select("ticker").distinct(), "ticker", "left_semi"), before, "ticker", "event_time", _BACK).select(*_CONTEXT)
    past = _published(spark, silver_path, _CONTEXT)
    return None if past is None else carry_context(past, before, lookback_days=lookback_days, keys=keys).select(*_CONTEXT)


def _extended(ctx: DataFrame | None, new_rows: DataFrame, kw: dict) -> DataFrame:
    """Filled rows and averages of ``new_rows`` after their context; the context's
    own rows are still there."""
    new_rows = new_rows.select(*_CONTEXT)
    if kw.get("strategy", "auto") == "auto":
        # bounded without evaluating the context twice
        kw = {**kw, "strategy": pick_strategy(new_rows, ["ticker"], kw.get("chunk_rows"), extra_rows=_BACK)}
    return enrich_all(new_rows if ctx is None else ctx.unionByName(new_rows), **kw)


def _checked(rows: DataFrame, report_path: str, mode: str, run_ts_utc: str, target, start, once: bool = False) -> dict:
    """Report, then gate."""
    metrics_df = staged(quality_metrics(rows.where(complete())), "metrics")
    write_report(report_row(metrics_df, run_ts_utc, mode, str(target), str(start) if start else None), report_path, once)
    return enforce(metrics_df, mode)


def _changes(spark: SparkSession, silver_path: str, rows: DataFrame, replaced, overwrite: str, state: DataFrame | None,
             partition_by, drop_empty: bool = True) -> dict[str, Change]:
    """What a run publishes: silver, the rows it leaves out, and the series state.
    ``replaced``: the days that ``rows`` stand for. A day without rows any more
    loses its folder."""
    left_path, order = leading_path(silver_path), ["ticker", "event_time"]
    parts = {"rows": (silver_path, rows.where(complete()), list(partition_by)), "leading": (left_path, rows.where(~complete()), ["trade_date"])}
    out = {}
    for name, (path, part, by) in parts.items():
        gone = []
        if overwrite == "incremental" and (name == "leading" or drop_empty):
            gone = _folders(spark, path, set(replaced) - _days(part))
        out[name] = Change(path, part.select(*_COLUMNS), by, order, overwrite, gone)
    if state is None:
        out["state"] = Change(state_path(silver_path), None, dropped=[state_path(silver_path)])
    else:
        out["state"] = Change(state_path(silver_path), state, sort_by=order, overwrite="full")
    return out


def _silver_rows(rows: DataFrame) -> DataFrame:
    """Staged: metrics, report and writes share one computation."""
    return staged(rows.select(*_COLUMNS), "silver")


def run_silver_from(spark: SparkSession, bronze_root: str, silver_path: str, report_path: str,
                    from_date, run_ts_utc: str, zone: str = "Asia/Ho_Chi_Minh",
                    lookback_days: int | None = 45, batch: str | None = None, partition_by=("trade_date",), **kw) -> dict:
    """Recompute every silver day >= ``from_date`` of all keys (bronze re-read from
    that day on, context from the series state) and replace exactly those days.
    Idempotent; :func:`run_silver_changes` recomputes only what changed."""
    start = dt.date.fromisoformat(str(from_date))
    apply_pending(spark, silver_path)
    with staging_scope():
        raw = normalize_bronze(read_bronze(spark, bronze_root, start, None), zone)
        state = read_state(spark, silver_path)
        ctx = _context(spark, silver_path, state, start, raw.select("ticker"), lookback_days)
        on = F.col("trade_date") >= day(start)
        rows = _silver_rows(_extended(ctx, raw, kw).where(on))
        metrics = _checked(rows, report_path, "incremental", run_ts_utc, start, start, batch is not None)
        days = _days(rows)
        old = _before(spark, silver_path, state, start)
        later = [dt.date.fromisoformat(f.rsplit("=", 1)[1]) for p in (silver_path, leading_path(silver_path))
                 for f in day_folders(spark, p, "trade_date", start)]
        new = _next_state(old, rows, max(days, default=start))
        changes = _changes(spark, silver_path, rows, days | set(later), "incremental", new, partition_by, bool(metrics["total_rows"]))
        publish_together(spark, silver_path, changes, run_ts_utc, "incremental", batch)
        return metrics


def _before(spark: SparkSession, silver_path: str, state: DataFrame | None, start: dt.date, after: dt.date | None = None) -> DataFrame | None:
    """The rows of which a state can be made once the days from ``start`` (to
    ``after``, if given) are replaced: the old state's, or without one that
    reaches back, those of the whole history."""
    horizon = horizon_of(state)
    if horizon is not None and start >= horizon:
        past = state.select(*_CONTEXT)
    else:
        past = _published(spark, silver_path, _CONTEXT)
    if past is None:
        return None
    kept = F.col("trade_date") < day(start)
    return past.where(kept if after is None else kept | (F.col("trade_date") > day(after)))


def _next_state(old: DataFrame | None, rows: DataFrame, newest: dt.date) -> DataFrame:
    rows = rows.select(*_CONTEXT)
    both = rows if old is None else old.select(*_CONTEXT).unionByName(rows)
    return staged(trimmed(both, newest, _CONTEXT, "ticker", "event_time", _BACK), "state")


def run_silver(spark: SparkSession, bronze_root: str, silver_path: str, report_path: str,
               mode: str, target_date, run_ts_utc: str, start_date=None, lookback_days: int = 45,
               zone: str = "Asia/Ho_Chi_Minh", carry_rows: bool = True, partition_by=("trade_date",), **kw) -> dict:
    """One silver run. Report appended before the gate; empty incremental runs
    skip the write of silver rows; full rebuilds replace everything, incremental
    runs the target date. Without any raw data in the window the run is skipped and
    an empty dict returned.

    The rows, the rows that silver leaves out and the series state are published
    together (:mod:`barlake.sources.versions`): a run that fails leaves them as they
    were, or is completed by the next one. ``start_date`` bounds local trade dates
    and only matters to a full rebuild. ``partition_by``: silver's layout, by day or
    by day and ticker; the same for every run."""
    target = dt.date.fromisoformat(str(target_date))
    start = dt.date.fromisoformat(str(start_date)) if start_date else None
    if start and start > target:
        raise ValueError("start date must be <= target date")
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown mode {mode!r}")
    apply_pending(spark, silver_path)
    with staging_scope():
        try:
            if mode == "full":
                raw = normalize_bronze(read_bronze(spark, bronze_root), zone)
            else:
                lo = target - dt.timedelta(days=0 if carry_rows else lookback_days)
                raw = normalize_bronze(read_bronze(spark, bronze_root, lo, target), zone)
        except EmptyWindow:
            return {}
        if mode == "full":
            if start:
                raw = raw.where(F.col("trade_date") >= day(start))
            rows = _silver_rows(enrich_all(raw, **kw))
            metrics = _checked(rows, report_path, mode, run_ts_utc, target, start)
            newest = rows.agg(F.max("trade_date")).first()[0]
            changes = _changes(spark, silver_path, rows, (), "full", _next_state(None, rows, newest), partition_by)
            publish_together(spark, silver_path, changes, run_ts_utc, mode)
            return metrics
        state, on = read_state(spark, silver_path), F.col("trade_date") == day(target)
        if carry_rows:
            ctx = _context(spark, silver_path, state, target, raw.select("ticker"), lookback_days)
            rows = _silver_rows(_extended(ctx, raw, kw).where(on))
        else:  # calendar days of bronze as context: its averages are its own, no state follows from them
            rows = _silver_rows(enrich_all(raw, **kw).where(on))
        metrics = _checked(rows, report_path, mode, run_ts_utc, target, start)
        new = None
        if carry_rows:
            newest = max([target, *([horizon_of(state) + dt.timedelta(days=KEEP_DAYS)] if horizon_of(state) else [])])
            new = _next_state(_before(spark, silver_path, state, target, target), rows, newest)
        changes = _changes(spark, silver_path, rows, [target], "incremental", new, partition_by, drop_empty=False)
        if not metrics["total_rows"]:
            changes["rows"].rows = None
        publish_together(spark, silver_path, changes, run_ts_utc, mode)
        return metrics


def landed_since(spark: SparkSession, bronze_root: str, since_utc: str) -> DataFrame:
    """(ticker, trade_date) of the bronze files written since a UTC time: partition
    values and file metadata alone, no data pages."""
    files = capitalize_columns(read_bronze(spark, bronze_root).select("*", "_metadata.file_modification_time"))
    return files.where(F.col("File_modification_time") >= F.lit(since_utc).cast("timestamp")).select(
        F.col("Ticker").alias("ticker"), F.col("Trade_date").alias("trade_date")).distinct()


def dirty_keys(changes: DataFrame) -> DataFrame:
    """(ticker, lo, hi): of every key with changed bars the first and the last day."""
    return changes.where("ticker IS NOT NULL AND trade_date IS NOT NULL").groupBy("ticker").agg(
        F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))


def _unsettled(raw: DataFrame, dirty: DataFrame) -> DataFrame:
    """Keys of ``dirty`` whose raw rows do not reach far enough past their last
    changed day: once every price has been seen anew, and a widest frame lies after
    that, all later rows are as they were."""
    cleaned = clean_keys(raw, "ticker", "event_time", defaults={"volume": 0}).join(dirty, "ticker")
    after = cleaned.where(F.col("trade_date") > F.col("hi"))
    seen = after.groupBy("ticker").agg(*[F.min(F.when(nan_to_null(c).isNotNull(), F.col("event_time"))).alias(c) for c in OHLC])
    settled = seen.select("ticker", F.when(F.expr(" AND ".join(f"{c} IS NOT NULL" for c in OHLC)), F.greatest(*OHLC)).alias("_from"))
    rows = after.select("ticker", "event_time").join(settled, "ticker").groupBy("ticker").agg(
        F.count_if(F.col("event_time") >= F.col("_from")).alias("n"))
    return dirty.select("ticker").join(rows.where(F.col("n") > _BACK), "ticker", "left_anti")


def run_silver_changes(spark: SparkSession, bronze_root: str, silver_path: str, report_path: str, changes: DataFrame,
                       run_ts_utc: str, zone: str = "Asia/Ho_Chi_Minh", lookback_days: int | None = 45,
                       first_days: int = 32, batch: str | None = None, partition_by=("trade_date",), **kw) -> dict:
    """Carry late or re-delivered bars into silver. ``changes`` names the landed
    (ticker, trade_date); silver must have been built before. Only those keys are
    read and computed, each from its first changed day until frames and fills meet
    the old rows again (``first_days`` days past the last change at first, then
    twice as many); only days with a different row are written. Equal to a full
    rebuild. ``partition_by``: silver's layout; with (trade_date, ticker) the files
    of other keys stay. An empty dict if nothing landed."""
    apply_pending(spark, silver_path)
    with staging_scope():
        dirty = staged(dirty_keys(changes), "dirty")
        lo, hi = dirty.agg(F.min("lo"), F.max("hi")).first()
        if lo is None:
            return {}
        last = max(f.rsplit("=", 1)[1] for f in day_folders(spark, bronze_root, "trade_date", lo))
        reach, end = first_days, hi
        while True:
            end = hi + dt.timedelta(days=reach)
            raw = normalize_bronze(read_bronze(spark, bronze_root, lo, end), zone)
            raw = raw.join(dirty.select("ticker", F.col("lo").alias("_from")), "ticker").where("trade_date >= _from").drop("_from")
            if str(end) >= last or _unsettled(raw, dirty).isEmpty():
                break
            reach *= 2
        raw = staged(raw, "late")

        state = read_state(spark, silver_path)
        ctx = None
        horizon = horizon_of(state)
        past = state.select(*_CONTEXT) if horizon is not None and lo >= horizon else _published(spark, silver_path, _CONTEXT)
        if past is not None:  # each key's rows before its own first changed day
            before = past.join(dirty.select("ticker", F.col("lo").alias("_from")), "ticker").where("trade_date < _from").drop("_from")
            if horizon is None or lo < horizon:
                before = carry_context(before, hi + dt.timedelta(days=1), lookback_days=(hi - lo).days + 1 + lookback_days if lookback_days else None,
                                       keys=dirty)
            ctx = staged(last_rows(before, "ticker", "event_time", _BACK), "context")
        rows = _extended(ctx, raw, kw).join(dirty.select("ticker", "lo"), "ticker").where("trade_date >= lo").drop("lo")
        rows = _silver_rows(rows)

        window = (F.col("trade_date") >= day(lo)) & (F.col("trade_date") <= day(end))
        published = _published(spark, silver_path, _COLUMNS)
        if published is None:
            published = rows.limit(0)
        published = published.where(window)
        old = published.join(dirty, "ticker").where("trade_date >= lo").select(*_COLUMNS)
        differing = staged(_differing(rows, old), "differing")
        days = sorted(_days(differing))
        on = F.col("trade_date").isin(days)
        others = published.where(on).join(dirty.withColumnRenamed("ticker", "_dirty"), (F.col("ticker") == F.col("_dirty")) & (F.col("trade_date") >= F.col("lo")), "left_anti")
        new = rows.where(on)
        by_key = "ticker" in partition_by
        if by_key:  # only the folders of changed (day, key)
            pairs = differing.select("trade_date", "ticker").distinct()
            whole = new.join(pairs, ["trade_date", "ticker"], "left_semi").select(*_COLUMNS)
            left = staged(others.where(~complete()).unionByName(new.where(~complete()).select(*_COLUMNS)), "changed")
            vanished = pairs.join(whole.where(complete()).select("trade_date", "ticker"), ["trade_date", "ticker"], "left_anti")
        else:
            whole = staged(others.select(*_COLUMNS).unionByName(new.select(*_COLUMNS)), "changed")
            left = whole.where(~complete())
        metrics = _checked(whole, report_path, "incremental", run_ts_utc, hi, lo, batch is not None)
        kept = _before_changes(past, dirty, end)
        newest = max([hi, *([horizon + dt.timedelta(days=KEEP_DAYS)] if horizon else []), *_days(rows)])
        state_rows = [f.select(*_CONTEXT) for f in (kept, ctx) if f is not None]
        base = None
        for f in state_rows:
            base = f if base is None else base.unionByName(f)
        plan = _changes(spark, silver_path, whole, days, "incremental", _next_state(base, rows, newest), partition_by)
        if by_key:
            plan["leading"].rows = left.select(*_COLUMNS)
            plan["leading"].dropped = _folders(spark, leading_path(silver_path), set(days) - _days(left))
            plan["rows"].dropped = [f"{silver_path.rstrip('/')}/trade_date={r.trade_date}/ticker={quote(r.ticker, safe=' ')}" for r in vanished.toLocalIterator()]
        publish_together(spark, silver_path, plan, run_ts_utc, "changes", batch)
        return metrics


def _before_changes(past: DataFrame | None, dirty: DataFrame, end: dt.date) -> DataFrame | None:
    """Of the old context rows those that still hold: all of other keys, and of the
    changed ones what lies past the recomputed window."""
    if past is None:
        return None
    same = past.join(dirty.select("ticker"), "ticker", "left_anti").select(*_CONTEXT)
    later = past.where(F.col("trade_date") > day(end)).join(dirty.select("ticker"), "ticker", "left_semi").select(*_CONTEXT)
    return same.unionByName(later)


def _differing(new: DataFrame, old: DataFrame) -> DataFrame:
    """(trade_date, ticker, event_time) of rows that only one side has, or that
    differ in any column. Rows are unique by key and time on both sides, or the gate
    stops the run."""
    key = ["trade_date", "ticker", "event_time"]
    n = new.select(*key, F.xxhash64(*_COLUMNS).alias("_n"))
    o = old.select(*key, F.xxhash64(*_COLUMNS).alias("_o"))
    return n.join(o, key, "full_outer").where(~F.col("_n").eqNullSafe(F.col("_o"))).select(*key)
