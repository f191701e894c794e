"""File-name keys (S5), column normalisation (P1-P3), table creation (S11),
and plan properties: partition pruning, pushed filters, top-k limits."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from barlake.operators.clean import capitalize_columns, dedupe_keep_last, normalize_schema, require_columns
from barlake.plans.gold import SCHEMAS, ensure_tables, read_table
from barlake.session import table
from barlake.sources.scan import dataset_exists, read_window, read_with_file_key
from barlake.sources.sinks import publish
from conftest import SF01


def test_file_name_key(spark, tmp_root):
    for name, v in (("aaa", 1.0), ("B_B", 2.0)):
        os.makedirs(f"{tmp_root}/2026/03", exist_ok=True)
        pq.write_table(pa.table({"time": [1, 2], "close": [v, v]}), f"{tmp_root}/2026/03/{name}.parquet")
    got = sorted((r.Ticker, r.close) for r in read_with_file_key(spark, f"{tmp_root}/2026").collect())
    assert got == [("AAA", 1.0), ("AAA", 1.0), ("B_B", 2.0), ("B_B", 2.0)]


def test_required_columns_checked_before_select(spark):
    df = capitalize_columns(spark.createDataFrame([(1, 2.0)], "time long, CLOSE double"))
    assert df.columns == ["Time", "Close"]
    with pytest.raises(ValueError, match="Open"):
        require_columns(df, ["Time", "Open"])
    with pytest.raises(ValueError):
        normalize_schema(df, {"open": ("Open", "double")})
    out = normalize_schema(df, {"close": ("Close", "decimal(19,4)"), "t": ("Time", "long")})
    assert out.dtypes == [("close", "decimal(19,4)"), ("t", "bigint")]


def test_ensure_tables_idempotent(spark, tmp_root):
    assert ensure_tables(spark, tmp_root) == {k: True for k in SCHEMAS}
    assert ensure_tables(spark, tmp_root) == {k: False for k in SCHEMAS}
    assert dataset_exists(spark, f"{tmp_root}/fact_prices")
    assert all(read_table(spark, tmp_root, n).count() == 0 for n in SCHEMAS)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_read_prunes_partitions(spark, tmp_root):
    e = table(spark, SF01, "events").withColumn("trade_date", F.to_date("ts"))
    publish(e, tmp_root + "/ev", ["trade_date"], mode="full", sort_by=["ts"])
    w = read_window(spark, tmp_root + "/ev", "trade_date", "2024-01-05", "2024-01-11").filter(F.col("value") > 10)
    plan = _plan(w)
    assert "PartitionFilters: [isnotnull(trade_date" in plan and "PushedFilters: [IsNotNull(value), GreaterThan(value,10.0)]" in plan
    assert w.select("trade_date").distinct().count() == 7


def test_projection_pruned_at_scan(spark):
    plan = _plan(table(spark, SF01, "lineitem").select("l_orderkey").filter("l_quantity > 3"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_top1_dedupe_uses_group_limit(spark):
    li = table(spark, SF01, "lineitem")
    plan = dedupe_keep_last(li, ["l_orderkey"], ["l_shipdate"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
