"""Run windows: extraction window, gold load window and batch slices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class EmptyWindow(Exception):
    """Nothing to load in the selected window: a run may skip it."""


def _date(v) -> dt.date:
    if isinstance(v, dt.datetime):
        return v.date()
    if isinstance(v, dt.date):
        return v
    try:
        return dt.datetime.strptime(str(v), "%Y-%m-%d").date()
    except ValueError as exc:
        raise ValueError(f"Invalid date {v!r}; expected YYYY-MM-DD") from exc


def minus_years(d: dt.date, years: int) -> dt.date:
    """Same calendar day ``years`` earlier; 29 Feb falls back to 28 Feb."""
    try:
        return d.replace(year=d.year - years)
    except ValueError:
        return d.replace(year=d.year - years, day=28)


def ingest_window(mode: str, date, start=None, years: int = 5, overlap_days: int = 3) -> tuple[dt.date, dt.date]:
    """daily: [date - overlap_days, date] (re-fetch overlap); backfill:
    [start or date - years, date]. start > end is an error."""
    end = _date(date)
    if mode == "daily":
        lo = end - dt.timedelta(days=overlap_days)
    elif mode == "backfill":
        lo = _date(start) if start else minus_years(end, years)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    if lo > end:
        raise ValueError("start date must be <= end date")
    return lo, end


def load_window(df: DataFrame, date_col: str, start=None, end=None) -> tuple[dt.date, dt.date]:
    """Bounds from the arguments, missing ones from min/max of the data (a
    one-row aggregate)."""
    row = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
    if row["lo"] is None:
        raise EmptyWindow("dataset has no valid dates")
    lo = _date(start) if start else _date(row["lo"])
    hi = _date(end) if end else _date(row["hi"])
    if lo > hi:
        raise ValueError("start date must be <= end date")
    return lo, hi


def batch_slices(lo, hi, days: int) -> list[tuple[dt.date, dt.date]]:
    """Consecutive inclusive slices of ``days`` days covering [lo, hi] once."""
    if days <= 0:
        raise ValueError("days must be > 0")
    lo, hi = _date(lo), _date(hi)
    out, cur = [], lo
    while cur <= hi:
        end = min(hi, cur + dt.timedelta(days=days - 1))
        out.append((cur, end))
        cur = end + dt.timedelta(days=1)
    return out


def slice_column(date_col: str, lo, days: int):
    """Slice number of each row's date (the set-based form of batch_slices)."""
    return F.floor(F.datediff(F.to_date(F.col(date_col)), F.lit(str(_date(lo))).cast("date")) / days).cast("int")
