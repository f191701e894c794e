"""Prefix-sum means, fact keys, landing gaps, the path index and skipped row groups."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barlake import cli
from barlake.operators.bars import build_bars
from barlake.operators.completeness import landing_gaps
from barlake.operators.series import rolling_mean
from barlake.operators.upsert import number_rows
from barlake.plans import gold
from barlake.sources import scan
from barlake.sources.path_index import files_in_window, path_index
from barlake.sources.sinks import publish


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


# ---------------------------------------------------------------- rolling means

@pytest.mark.parametrize("strategy", [{"strategy": "direct"}, {"chunk_rows": 7}, {"chunk_rows": 1000}])
def test_prefix_means_equal_frames(spark, strategy):
    rnd = random.Random(3)
    data = [(k, t, None if rnd.random() < 0.3 else rnd.randint(-10**9, 10**9) / 64) for k in ("a", "b", None) for t in range(60)] + [("n", t, None) for t in range(9)]
    df = spark.createDataFrame(data, "k string, t int, v double")
    args = (df, "k", "t", "v", (1, 2, 5))
    got, want = (rows(rolling_mean(*args, method=m, **kw)) for m, kw in (("prefix", strategy), ("frame", {"strategy": "direct"})))
    assert [r[:3] for r in got] == [r[:3] for r in want] and rolling_mean(*args, method="prefix", **strategy).columns == ["k", "t", "v", "ma1", "ma2", "ma5"]
    for g, w in zip(got, want):
        assert g[3:] == pytest.approx(w[3:], rel=1e-12) if None not in w[3:] else g[3:] == w[3:]


def test_prefix_means_are_exact_where_frames_drift(spark):
    df = spark.createDataFrame([("a", t, v) for t, v in enumerate([1e12, 0.1, 0.2, 0.3, -1e12, 0.1])], "k string, t int, v double")
    assert [r.ma3 for r in rolling_mean(df, "k", "t", "v", (3,), method="prefix").orderBy("t").collect()][3] == pytest.approx(0.2, rel=1e-15)
    for bad in (float("nan"), float("inf"), 1e13):
        with pytest.raises(Exception, match="finite"):
            rolling_mean(spark.createDataFrame([("a", 1, bad)], "k string, t int, v double"), "k", "t", "v", (3,), method="prefix").collect()


def test_prefix_plan_has_no_wide_frames(spark):
    df = spark.createDataFrame([("a", 1, 1.0)], "k string, t int, v double")
    plan = rolling_mean(df, "k", "t", "v", method="prefix", strategy="direct")._jdf.queryExecution().executedPlan().toString()
    assert "specifiedwindowframe(RowFrame, -199, currentrow$())" not in plan and plan.count("Exchange") == 1


# ---------------------------------------------------------------- fact keys

def test_numbers_are_dense_without_a_shuffle_of_the_rows(spark):
    df = spark.range(0, 1000, 1, 7).where("id % 3 <> 1 OR id > 500")
    out = number_rows(df, "n", 11)
    n = df.count()
    assert sorted(r.n for r in out.collect()) == list(range(11, 11 + n))
    assert number_rows(df.where("id < 0"), "n", 1).count() == 0


def facts(spark, days, bump=0.0):
    data = [(k, dt.datetime(2024, 1, d, 5), *[p + bump + d] * 4, 7, *[1.0] * 4, dt.date(2024, 1, d)) for d in days for k, p in (("a", 1.0), ("b", 2.0))]
    return spark.createDataFrame(data, "ticker string, event_time timestamp_ntz, open double, high double, low double, close double, volume long, "
                                       "ma10 double, ma20 double, ma50 double, ma200 double, trade_date date")


def test_fact_keys_stay_through_upserts(spark, tmp_root):
    loads = [facts(spark, [1, 2, 3]), facts(spark, [2, 3, 4, 5], 0.5), facts(spark, [5], 0.7)]
    seen = {}
    for k, df in enumerate(loads):
        publish(df, f"{tmp_root}/s{k}", ["trade_date"])
        gold.run_gold(spark, f"{tmp_root}/s{k}", f"{tmp_root}/g", "2024-02-01 00:00:00", zone="UTC")
        now = {(r.ticker_key, r.event_time): r.fact_price_key for r in gold.read_table(spark, f"{tmp_root}/g", "fact_prices").collect()}
        assert len(set(now.values())) == len(now) and all(now[key] == n for key, n in seen.items())
        assert gold.highest_fact_key(spark, f"{tmp_root}/g") == max(now.values())
        seen = now
    assert sorted(seen.values()) == list(range(1, 11))


# ---------------------------------------------------------------- landing gaps

def test_gaps_of_each_key(spark):
    at = lambda h: dt.datetime(2024, 1, 1, h)
    landed = [("a", h) for h in (1, 2, 3, 5, 9)] + [("b", h) for h in (2, 3)] + [("other", 7), ("a", 1), (None, 8)]
    bars = spark.createDataFrame([(k, at(h)) for k, h in landed] + [("a", None)], "ticker string, event_time timestamp_ntz")
    universe = spark.createDataFrame([("a",), ("b",), ("none",), ("a",), (None,)], "symbol string")
    want = sorted([("a", at(7), at(7), 1), ("b", at(1), at(1), 1), ("b", at(5), at(9), 3), ("none", at(1), at(9), 6)])
    for kw in ({"strategy": "auto"}, {"chunk_rows": 3}):
        assert rows(landing_gaps(bars, universe, **kw)) == want
    assert rows(landing_gaps(bars.limit(0), universe)) == [] and rows(landing_gaps(bars, universe.limit(0))) == []


# ---------------------------------------------------------------- files

def mixed(spark, root):
    df = facts(spark, range(1, 11))
    df.where("day(trade_date) <= 6").write.partitionBy("trade_date", "ticker").parquet(f"{root}/m")
    df.where("day(trade_date) BETWEEN 7 AND 8").drop("trade_date").write.partitionBy("ticker").parquet(f"{root}/m/old")
    df.where("day(trade_date) > 8").withColumnRenamed("trade_date", "Trade_date").write.partitionBy("Trade_date").parquet(f"{root}/m/new")
    return f"{root}/m"


def test_path_index_picks_files_before_reading(spark, tmp_root):
    path = mixed(spark, tmp_root)
    index = path_index(spark, path)
    assert sorted({(str(r.day), r.key) for r in index.collect()}, key=str) == sorted(
        [(f"2024-01-0{d}", k) for d in range(1, 7) for k in "ab"] + [("None", "a"), ("None", "b"), ("2024-01-09", None), ("2024-01-10", None)], key=str)
    assert all(r.bytes > 0 for r in index.collect())
    in_window = files_in_window(index, "2024-01-02", "2024-01-03", keys=["b"])
    assert {f.split("/m/")[1].rsplit("/", 1)[0] for f in in_window} == {"trade_date=2024-01-02/ticker=b", "trade_date=2024-01-03/ticker=b", "old/ticker=b"}
    plan = gold.load_silver(spark, path, "mixed", "2024-01-09", "2024-01-09").inputFiles()
    assert not any("trade_date=" in f for f in plan) and any("Trade_date=2024-01-09" in f for f in plan) and not any("2024-01-10" in f for f in plan)


def test_batches_read_each_mixed_file_once(spark, tmp_root, monkeypatch):
    path = mixed(spark, tmp_root)
    opened, real = [], scan.scan_recursive
    monkeypatch.setattr(scan, "scan_recursive", lambda s, *paths, **k: opened.extend(paths) or real(s, *paths, **k))
    cli.main(["gold", "--silver", path, "--gold", f"{tmp_root}/g", "--batch-days", "2", "--layout", "mixed", "--zone", "UTC"])
    assert len(opened) == len(set(opened)) == path_index(spark, path).count()
    monkeypatch.undo()
    gold.run_gold(spark, path, f"{tmp_root}/one", "2024-02-01 00:00:00", zone="UTC", layout="mixed")
    cols = ["ticker_key", "event_time", "close_price", "date_key"]
    assert rows(gold.read_table(spark, f"{tmp_root}/g", "fact_prices"), *cols) == rows(gold.read_table(spark, f"{tmp_root}/one", "fact_prices"), *cols) != []


def scanned(df):
    """Rows that the scan of an executed plan gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    stack, total = [plan], 0
    while stack:
        node = stack.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        stack += [children.apply(k) for k in range(children.size())]
    return total


def test_a_ticker_over_all_dates_reads_few_row_groups(spark, tmp_root):
    """Each day has every second key, so its key range holds those it does not have."""
    df = spark.range(40 * 500).select(
        (20240101 + F.col("id") % 40).cast("int").alias("date_key"), (2 * F.expr("id div 40") + F.col("id") % 2).alias("ticker_key"), F.col("id").alias("v"))
    path = f"{tmp_root}/f"
    publish(df, path, ["date_key"], sort_by=["ticker_key"], bloom=["ticker_key"])
    out = spark.read.parquet(path).where("ticker_key = 501")
    assert out.count() == 20 and scanned(spark.read.parquet(path).where("ticker_key = 501")) == 20 * 500  # of 40 * 500
    assert scanned(spark.read.parquet(path).where("ticker_key = 501 AND date_key = 20240102")) == 500


def test_bars_keep_ticks_without_a_tie_break(spark):
    t = dt.datetime(2024, 1, 1, 5)
    data = [("a", t, None, 10.0), ("a", t, 5, 20.0), ("a", t + dt.timedelta(minutes=9), None, 30.0)]
    for kind in ("long", "string"):
        df = spark.createDataFrame([(k, at, i if i is None or kind == "long" else str(i), v) for k, at, i, v in data], f"k string, t timestamp_ntz, i {kind}, v double")
        assert rows(build_bars(df, "k", "t", "v", tie_break=["i"]), "open", "close") == [(10.0, 30.0)]
