"""End to end: bronze landing -> silver (full, incremental) -> gold, with
incremental == full (C9), idempotent reruns, paths (C10), overwrites (C11)
and load windows (C12)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barlake.operators.bars import build_bars
from barlake.plans import gold, silver
from barlake.plans.windows import batch_slices, ingest_window, load_window
from barlake.session import table
from barlake.sources.scan import read_with_path_key, scan_partitioned, scan_recursive
from barlake.sources.sinks import land_bronze, publish, staged_overwrite
from conftest import SF001

RUN_TS = "2024-02-01T00:00:00Z"


def _land(spark, root, events):
    """Vendor-style hourly bars (naive local ns time) landed as bronze."""
    bars = build_bars(events, ["event_type"], "ts", "value", None, "1 hour", tie_break=["event_id"], bar_time="t")
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', t)")
    gap = F.hour("t") % 5 == 0  # a missing bar: all four prices NULL
    landed = bars.select(
        F.upper("event_type").alias("Ticker"), (micros * 1000).alias("Time"),
        *[F.when(gap, None).otherwise(F.col(c.lower())).alias(c) for c in ("Open", "High", "Low", "Close")],
        F.col("volume").alias("Volume"), F.to_date("t").alias("Trade_date"))
    land_bronze(landed, root)


def _silver_rows(spark, path, day=None):
    df = scan_partitioned(spark, path)
    if day:
        df = df.filter(F.col("trade_date") == F.lit(day).cast("date"))
    return sorted(tuple(r) for r in df.select("ticker", "event_time", "open", "close", "ma10", "ma200").collect())


def test_bronze_silver_gold(spark, tmp_root):
    events = table(spark, SF001, "events")
    bronze, full, inc = f"{tmp_root}/bronze", f"{tmp_root}/silver_full", f"{tmp_root}/silver_inc"
    report, groot = f"{tmp_root}/report", f"{tmp_root}/gold"
    _land(spark, bronze, events)
    m = silver.run_silver(spark, bronze, full, report, "full", "2024-01-30", RUN_TS, strategy="chunked", chunk_rows=257)
    assert m["total_rows"] > 0 and m["duplicate_key_count"] == 0 and m["ohlc_null_count"] == 0

    # incremental: days up to 01-19 published, then 01-20 processed alone with carried rows
    silver.run_silver(spark, bronze, inc, report, "full", "2024-01-19", RUN_TS, strategy="chunked", chunk_rows=257)
    pruned = scan_partitioned(spark, inc).filter(F.col("trade_date") <= F.lit("2024-01-19").cast("date"))
    staged = f"{tmp_root}/silver_inc2"
    publish(pruned, staged, ["trade_date"], mode="full")
    for _ in range(2):  # rerun is idempotent
        silver.run_silver(spark, bronze, staged, report, "incremental", "2024-01-20", RUN_TS, strategy="chunked", chunk_rows=257)
    assert _silver_rows(spark, staged, "2024-01-20") == _silver_rows(spark, full, "2024-01-20")
    assert len(_silver_rows(spark, staged, "2024-01-20")) > 0

    # a short lookback instead of carried rows gives different MA200 (guards the test above)
    short = f"{tmp_root}/silver_short"
    silver.run_silver(spark, bronze, short, report, "incremental", "2024-01-20", RUN_TS, carry_rows=False,
                      lookback_days=1, strategy="chunked", chunk_rows=257)
    assert _silver_rows(spark, short, "2024-01-20") != _silver_rows(spark, full, "2024-01-20")

    # the report was appended once per run (5 runs), all partitions readable
    from barlake.operators.quality import REPORT_SCHEMA
    assert spark.read.schema(REPORT_SCHEMA).parquet(report).count() == 5

    snap1 = gold.run_gold(spark, full, groot, "2024-02-01 00:00:00", zone="Asia/Ho_Chi_Minh")
    fact1 = sorted(tuple(r) for r in spark.read.parquet(f"{groot}/fact_prices").collect())
    snap2 = gold.run_gold(spark, full, groot, "2024-02-01 00:00:00", zone="Asia/Ho_Chi_Minh")
    fact2 = sorted(tuple(r) for r in spark.read.parquet(f"{groot}/fact_prices").collect())
    assert snap1 == snap2 and fact1 == fact2
    n = scan_partitioned(spark, full).count()
    assert snap1 == {"dim_ticker_count": 5, "dim_date_count": snap1["dim_date_count"],
                     "fact_prices_count": n, "ml_feature_rows": n}
    dt_ = spark.read.parquet(f"{groot}/dim_ticker")
    assert sorted(r.ticker for r in dt_.collect()) == sorted(t.upper() for (t,) in events.select("event_type").distinct().collect())


def test_path_layouts(spark, tmp_root):
    df = spark.createDataFrame([(1, "AAA", dt.date(2026, 1, 2)), (2, "B B", dt.date(2026, 1, 2))],
                               "x int, ticker string, trade_date date")
    df.write.partitionBy("trade_date", "ticker").parquet(f"{tmp_root}/ds")
    df.select("x", "ticker").write.mode("append").partitionBy("ticker").parquet(f"{tmp_root}/ds/legacy")
    df.select("x").write.mode("append").parquet(f"{tmp_root}/ds/nokey")
    with pytest.raises(Exception):
        spark.read.parquet(f"{tmp_root}/ds").collect()  # conflicting layouts
    got = sorted((r.x, r.ticker or "") for r in read_with_path_key(spark, f"{tmp_root}/ds").collect())
    assert got == [(1, ""), (1, "AAA"), (1, "AAA"), (2, ""), (2, "B B"), (2, "B B")]
    assert scan_recursive(spark, f"{tmp_root}/ds").count() == 6


def test_partition_overwrite_modes(spark, tmp_root):
    path = f"{tmp_root}/p"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    publish(df, path, ["p"], mode="full")
    publish(spark.createDataFrame([(3, "b")], "v int, p string"), path, ["p"], mode="incremental")
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("v", "p").collect()) == [(1, "a"), (3, "b")]
    staged_overwrite(spark.read.parquet(path).filter("p = 'b'").withColumn("v", F.col("v") + 1), path, ["p"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("v", "p").collect()) == [(1, "a"), (4, "b")]
    publish(spark.createDataFrame([(5, "b")], "v int, p string"), path, ["p"], mode="full")
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("v", "p").collect()) == [(5, "b")]


def test_windows(spark):
    assert ingest_window("daily", "2026-03-30") == (dt.date(2026, 3, 27), dt.date(2026, 3, 30))
    assert ingest_window("backfill", "2028-02-29") == (dt.date(2023, 2, 28), dt.date(2028, 2, 29))
    with pytest.raises(ValueError):
        ingest_window("backfill", "2026-01-01", start="2026-02-01")
    df = spark.createDataFrame([(dt.date(2026, 1, 5),), (dt.date(2026, 2, 20),)], "d date")
    assert load_window(df, "d") == (dt.date(2026, 1, 5), dt.date(2026, 2, 20))
    assert load_window(df, "d", start="2026-01-10") == (dt.date(2026, 1, 10), dt.date(2026, 2, 20))
    assert load_window(df, "d", end="2026-01-31") == (dt.date(2026, 1, 5), dt.date(2026, 1, 31))
    with pytest.raises(ValueError):
        load_window(df, "d", start="2026-03-01")
    sl = batch_slices(dt.date(2026, 1, 5), dt.date(2026, 2, 20), 31)
    assert sl == [(dt.date(2026, 1, 5), dt.date(2026, 2, 4)), (dt.date(2026, 2, 5), dt.date(2026, 2, 20))]


def test_cli_silver_and_gold(spark, tmp_root):
    from barlake import cli

    _land(spark, f"{tmp_root}/bronze", table(spark, SF001, "events"))
    m = cli.main(["silver", "--bronze", f"{tmp_root}/bronze", "--silver", f"{tmp_root}/silver",
                  "--report", f"{tmp_root}/report", "--mode", "full", "--target-date", "2024-01-30"])
    assert m["total_rows"] > 0
    snap = cli.main(["gold", "--silver", f"{tmp_root}/silver", "--gold", f"{tmp_root}/gold", "--batch-days", "10"])
    assert snap["fact_prices_count"] == m["total_rows"] == snap["ml_feature_rows"]
    with pytest.raises(SystemExit):
        cli.main(["gold", "--silver", "x", "--gold", "y", "--start-date", "2024-02-01", "--end-date", "2024-01-01"])


def test_gold_layouts_agree_and_start_bound(spark, tmp_root):
    events = table(spark, SF001, "events")
    bronze, sv = f"{tmp_root}/bronze", f"{tmp_root}/silver"
    _land(spark, bronze, events)
    silver.run_silver(spark, bronze, sv, f"{tmp_root}/r", "full", "2024-01-30", RUN_TS, start_date="2024-01-10")
    assert scan_partitioned(spark, sv).agg(F.min("trade_date")).first()[0] == dt.date(2024, 1, 10)
    facts = []
    for layout in ("canonical", "mixed"):
        root = f"{tmp_root}/gold_{layout}"
        gold.run_gold(spark, sv, root, "2024-02-01 00:00:00", layout=layout)
        facts.append(sorted(tuple(r) for r in scan_partitioned(spark, f"{root}/fact_prices")
                            .select("ticker_key", "event_time", "close_price", "ma200").collect()))
    assert facts[0] == facts[1] and len(facts[0]) > 0
    windowed = f"{tmp_root}/gold_window"
    gold.run_gold(spark, sv, windowed, "2024-02-01 00:00:00", start="2024-01-15", end="2024-01-20")
    days = scan_partitioned(spark, f"{windowed}/fact_prices").select("date_key").distinct().collect()
    assert sorted(r[0] for r in days) == list(range(20240115, 20240121))
