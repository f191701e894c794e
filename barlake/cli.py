"""Command line entry points mirroring the pipeline's runs:

    python -m barlake.cli silver --bronze B --silver S --report R --mode incremental --target-date 2026-03-30
    python -m barlake.cli gold   --silver S --gold G [--start-date D] [--end-date D] [--batch-days N]
    python -m barlake.cli stream --bronze B --silver S --report R

Paths may be any Hadoop-compatible URI; the session comes from spark-submit
(or a local one when run directly).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from .functions.time import utc_now_second
from .plans import gold, silver
from .plans.windows import EmptyWindow, batch_slices, load_window
from .session import scratch_path


def _date(s: str | None) -> dt.date | None:
    if not s:
        return None
    try:
        return dt.date.fromisoformat(s)
    except ValueError as exc:
        raise SystemExit(f"invalid date {s!r}: expected YYYY-MM-DD") from exc


def main(argv=None) -> dict:
    p = argparse.ArgumentParser(prog="barlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--report", required=True)
    s.add_argument("--mode", choices=["incremental", "full", "changes"], default="incremental")
    s.add_argument("--since", default=None, help="changes: carry in the bronze files written since this UTC time")
    s.add_argument("--target-date", default=dt.date.today().isoformat())
    s.add_argument("--lookback-days", type=int, default=45)
    s.add_argument("--start-date", default=None)
    s.add_argument("--zone", default="Asia/Ho_Chi_Minh")
    g = sub.add_parser("gold")
    g.add_argument("--silver", required=True)
    g.add_argument("--gold", required=True)
    g.add_argument("--start-date", default=None)
    g.add_argument("--end-date", default=None)
    g.add_argument("--batch-days", type=int, default=None)
    g.add_argument("--zone", default="Asia/Ho_Chi_Minh")
    g.add_argument("--layout", choices=["canonical", "mixed"], default="canonical")
    st = sub.add_parser("stream")
    st.add_argument("--bronze", required=True)
    st.add_argument("--silver", required=True)
    st.add_argument("--report", required=True)
    st.add_argument("--checkpoint", default=None)
    st.add_argument("--continuous", action="store_true", help="keep running (default: process what landed, stop)")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"barlake-{args.cmd}").getOrCreate()
    run_ts = utc_now_second()
    if args.cmd == "silver" and args.mode == "changes":
        if not args.since:
            raise SystemExit("--mode changes needs --since")
        changes = silver.landed_since(spark, args.bronze, args.since)
        out = silver.run_silver_changes(spark, args.bronze, args.silver, args.report, changes, run_ts.replace(" ", "T") + "Z", zone=args.zone,
                                        lookback_days=args.lookback_days)
    elif args.cmd == "silver":
        out = silver.run_silver(spark, args.bronze, args.silver, args.report, args.mode, _date(args.target_date),
                                run_ts.replace(" ", "T") + "Z", start_date=_date(args.start_date),
                                lookback_days=args.lookback_days, zone=args.zone)
    elif args.cmd == "gold":
        start, end = _date(args.start_date), _date(args.end_date)
        if start and end and end < start:
            raise SystemExit(f"the window ends ({end}) before it starts ({start})")
        if args.batch_days is not None and args.batch_days < 1:
            raise SystemExit(f"a batch needs at least one day, got {args.batch_days}")
        slices = [(start, end)]
        try:
            if args.batch_days:  # bound each load to N days; each slice is one distributed job
                if args.layout == "mixed":  # every file is read once, not once a slice
                    args.silver = gold.canonical_copy(spark, args.silver, scratch_path(spark, "canonical"))
                    args.layout = "canonical"
                days = gold.gold_dates(gold.load_silver(spark, args.silver, args.layout), args.zone)
                slices = batch_slices(*load_window(days, "full_date", start, end), args.batch_days)
        except EmptyWindow as nothing:
            raise SystemExit(f"no gold batch was loaded: {nothing}") from nothing
        out = {}
        for first, last in slices:
            try:
                out = gold.run_gold(spark, args.silver, args.gold, run_ts, first, last, args.zone, args.layout)
            except EmptyWindow:  # a slice without rows; any other error ends the run
                continue
        if not out:
            raise SystemExit("no gold batch was loaded; check the window and the silver data")
    else:
        from .streaming import start_silver_stream

        q = start_silver_stream(spark, args.bronze, args.silver, args.report,
                                checkpoint=args.checkpoint, available_now=not args.continuous)
        q.awaitTermination()
        out = {"stream": "stopped"}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
