"""Bounded reads give the same rows as unbounded ones: the carried context of
thin series, and gold upserts of overlapping windows."""

import datetime as dt

from barlake.plans import gold, silver
from barlake.session import table
from barlake.sources.scan import scan_partitioned
from conftest import SF001
from test_pipeline import RUN_TS, _land

LOAD_TS = "2024-02-01 00:00:00"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_carry_context_of_thin_series_equals_whole_history(spark, tmp_root):
    bronze, path = f"{tmp_root}/bronze", f"{tmp_root}/silver"
    _land(spark, bronze, table(spark, SF001, "events"))
    silver.run_silver(spark, bronze, path, f"{tmp_root}/report", "full", "2024-01-30", RUN_TS)
    history = scan_partitioned(spark, path)
    keys = history.select("ticker").distinct()
    day = dt.date(2024, 1, 20)
    full = _rows(silver.carry_context(history, day, lookback_days=None))
    # lookback 1 day: every key is short of 199 rows; a long lookback: none is
    assert full and _rows(silver.carry_context(history, day, lookback_days=1, keys=keys)) == full
    assert _rows(silver.carry_context(history, day, lookback_days=400, rows=3, keys=keys)) == _rows(
        silver.carry_context(history, day, lookback_days=None, rows=3))


def test_overlapping_gold_windows_equal_one_load(spark, tmp_root):
    bronze, path = f"{tmp_root}/bronze", f"{tmp_root}/silver"
    _land(spark, bronze, table(spark, SF001, "events"))
    silver.run_silver(spark, bronze, path, f"{tmp_root}/report", "full", "2024-01-30", RUN_TS)
    one, two = f"{tmp_root}/one", f"{tmp_root}/two"
    gold.run_gold(spark, path, one, LOAD_TS)
    gold.run_gold(spark, path, two, LOAD_TS, end="2024-01-15")
    snap = gold.run_gold(spark, path, two, LOAD_TS, start="2024-01-10")
    facts = [gold.read_table(spark, root, "fact_prices") for root in (one, two)]
    fact = _rows(facts[1].drop("fact_price_key"))
    assert fact == _rows(facts[0].drop("fact_price_key")) and snap["fact_prices_count"] == len(fact) > 0
