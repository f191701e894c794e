"""MERGE semantics, idempotence, surrogate keys (FIXTURES C8)."""

from pyspark.sql import functions as F

from barlake.operators.upsert import assign_keys, upsert
from barlake.plans.gold import ticker_dim
from conftest import rows


def test_upsert_update_insert_keep(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    out = upsert(t, s, ["k"], action_col="action")
    assert sorted(rows(out)) == [(1, "a", "keep"), (2, "B", "update"), (3, "C", "insert")]
    once = upsert(t, s, ["k"])
    twice = upsert(once, s, ["k"])
    assert sorted(rows(once)) == sorted(rows(twice))
    assert sorted(rows(upsert(t, s.limit(0), ["k"]))) == [(1, "a"), (2, "b")]
    assert sorted(rows(upsert(t.limit(0), s, ["k"]))) == [(2, "B"), (3, "C")]


def test_surrogate_keys_stable_and_dense(spark):
    first = assign_keys(None, spark.createDataFrame([("B",), ("A",), ("A",)], "n string"), "n", "sk")
    assert sorted(rows(first)) == [("A", 1), ("B", 2)]
    second = assign_keys(first, spark.createDataFrame([("C",), ("A",), ("0",), (None,)], "n string"), "n", "sk")
    assert sorted(rows(second)) == [("0", 3), ("A", 1), ("B", 2), ("C", 4)]


def test_ticker_dim_scd1(spark):
    src = spark.createDataFrame([("AAA",), ("BBB",)], "ticker string")
    d1 = ticker_dim(None, src, "2026-01-01 00:00:00")
    d1 = d1.withColumn("is_active", F.when(F.col("ticker") == "AAA", False).otherwise(True))
    d2 = ticker_dim(d1, spark.createDataFrame([("AAA",), ("CCC",)], "ticker string"), "2026-01-02 00:00:00")
    got = {r.ticker: r for r in d2.collect()}
    assert got["AAA"].ticker_key == 1 and got["AAA"].is_active is True
    assert str(got["AAA"].created_at) == "2026-01-01 00:00:00" and str(got["AAA"].updated_at) == "2026-01-02 00:00:00"
    assert got["BBB"].updated_at == got["BBB"].created_at  # untouched, not deactivated
    assert got["CCC"].ticker_key == 3 and got["CCC"].exchange == "HOSE" and got["CCC"].sector is None
