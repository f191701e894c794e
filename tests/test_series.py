"""Forward fill, moving averages and lead: edge tables (FIXTURES C1, C2) and
the chunked (skew-safe) strategy against the single-partition one."""

import math

import pytest
from pyspark.sql import functions as F

from barlake.operators.series import forward_fill, lead_target, rolling_mean, series_windows, with_position
from barlake.session import table
from conftest import SF01

NAN = float("nan")


def _c1(spark):
    data = [("A", 1, 1.0), ("A", 2, None), ("A", 3, NAN), ("A", 4, None), ("A", 5, 5.0)]
    return spark.createDataFrame(data, "k string, t int, close double")


def _build_ma2(spec):
    return [F.avg("close").over(spec.rowsBetween(-1, 0)).alias("ma2")]


@pytest.mark.parametrize("strategy", ["direct", "chunked"])
def test_fill_nan_as_null_default(spark, strategy):
    out = series_windows(_c1(spark), "k", "t", ["close"], _build_ma2, halo_before=1, strategy=strategy, chunk_rows=2)
    got = sorted((r.t, r.close, r.ma2) for r in out.collect())
    assert got == [(1, 1.0, 1.0), (2, 1.0, 1.0), (3, 1.0, 1.0), (4, 1.0, 1.0), (5, 5.0, 3.0)]


@pytest.mark.parametrize("strategy", ["direct", "chunked"])
def test_fill_keeps_nan_when_asked(spark, strategy):
    out = series_windows(_c1(spark), "k", "t", ["close"], _build_ma2, halo_before=1, strategy=strategy,
                         chunk_rows=2, nan_as_null=False)
    got = {r.t: (r.close, r.ma2) for r in out.collect()}
    assert got[1] == (1.0, 1.0) and got[2] == (1.0, 1.0)
    assert math.isnan(got[3][0]) and math.isnan(got[4][0]) and got[5][0] == 5.0
    assert all(math.isnan(got[t][1]) for t in (3, 4, 5))


def test_leading_nulls_stay_null(spark):
    df = spark.createDataFrame([("A", 1, None), ("A", 2, None), ("A", 3, 3.0)], "k string, t int, close double")
    out = rolling_mean(forward_fill(df, "k", "t", ["close"], chunk_rows=2), "k", "t", "close", (10,), chunk_rows=20)
    got = sorted((r.t, r.close, r.ma10) for r in out.collect())
    assert got == [(1, None, None), (2, None, None), (3, 3.0, 3.0)]


def test_ma1_is_identity_and_fill_idempotent(spark):
    e = table(spark, SF01, "events").select("event_type", "ts", "event_id", "value")
    once = forward_fill(e, "event_type", ["ts", "event_id"], ["value"], chunk_rows=1000)
    twice = forward_fill(once, "event_type", ["ts", "event_id"], ["value"], chunk_rows=777)
    assert once.exceptAll(twice).count() == 0
    ma = rolling_mean(e, "event_type", ["ts", "event_id"], "value", (1,), chunk_rows=500)
    assert ma.filter(F.col("ma1") != F.col("value")).count() == 0


def test_position_is_dense_rank(spark):
    e = table(spark, SF01, "events").select("event_type", "ts", "event_id")
    p = with_position(e, ["event_type"], ["ts", "event_id"], num_partitions=7)
    n = e.count()
    assert p.agg(F.min("_bl_pos"), F.max("_bl_pos"), F.countDistinct("_bl_pos")).first() == (0, n - 1, n)
    from pyspark.sql import Window
    ref = e.withColumn("g", F.row_number().over(Window.orderBy("event_type", "ts", "event_id")) - 1)
    assert p.join(ref, ["event_type", "ts", "event_id"]).filter("g != _bl_pos").count() == 0


@pytest.mark.parametrize("chunk", [211, 256, 1500])
def test_chunked_equals_direct(spark, chunk):
    """Fill + 4 MAs + lag/lead over 150 user series and 5 long event_type
    series; chunks far smaller than a series force halos and carries."""
    e = table(spark, SF01, "events")
    b = e.select("event_id", "user_id", "event_type", "ts",
                 F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("value")).alias("v"))

    def build(spec):
        return [F.avg("v").over(spec.rowsBetween(-n + 1, 0)).alias(f"ma{n}") for n in (10, 200)] + [
            F.lead("v").over(spec).alias("nxt"), F.lag("v").over(spec).alias("prv")]

    for key in ("event_type", "user_id"):
        args = dict(fill_cols=["v"], build=build, halo_before=199, halo_after=1)
        d = series_windows(b, key, ["ts", "event_id"], strategy="direct", **args)
        c = series_windows(b, key, ["ts", "event_id"], strategy="chunked", chunk_rows=chunk, **args)
        assert c.count() == d.count() == e.count()
        assert c.exceptAll(d).count() == 0 and d.exceptAll(c).count() == 0


def test_lead_across_chunks(spark):
    df = spark.createDataFrame([("A", i, float(i)) for i in range(10)] + [("B", i, -float(i)) for i in range(3)],
                               "k string, t int, x double")
    out = lead_target(df, "k", "t", "x", "nx", chunk_rows=3)
    got = {(r.k, r.t): r.nx for r in out.collect()}
    assert got[("A", 2)] == 3.0 and got[("A", 9)] is None and got[("B", 0)] == -1.0 and got[("B", 2)] is None


def test_chunk_must_exceed_reach(spark):
    with pytest.raises(ValueError):
        rolling_mean(_c1(spark), "k", "t", "close", (10,), chunk_rows=5)


def test_hot_key_is_split(spark):
    """One key with more than a third of all rows: the chunked plan's largest
    unit of work stays at chunk_rows + halo, the direct plan's is the key."""
    from barlake.operators.series import chunk_layout

    e = table(spark, SF01, "events")
    hot = e.select(F.when(F.col("user_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("k"),
                   "ts", "event_id", "value")
    n_hot = hot.filter("k = -1").count()
    assert n_hot * 3 > e.count()
    layout = chunk_layout(hot, "k", ["ts", "event_id"], chunk_rows=500, halo_before=199, halo_after=1)
    assert layout.agg(F.max("rows")).first()[0] <= 500 + 199 + 1
    assert layout.filter("k = -1").count() >= n_hot // 500
    d = rolling_mean(hot, "k", ["ts", "event_id"], "value", (10, 200), strategy="direct")
    c = rolling_mean(hot, "k", ["ts", "event_id"], "value", (10, 200), chunk_rows=500)
    assert c.exceptAll(d).count() == 0 and d.count() == c.count()


def test_auto_strategy_checks_the_largest_series(spark):
    """``auto`` runs the single-task window only behind a measured bound: a
    hot key larger than one chunk switches the plan to the chunked strategy,
    and both plans give the same rows."""
    from barlake.operators.series import max_rows_per_key, pick_strategy

    e = table(spark, SF01, "events")
    hot = e.select(F.when(F.col("user_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("k"),
                   "ts", "event_id", "value")
    n_hot = hot.filter("k = -1").count()
    assert max_rows_per_key(hot, "k") == n_hot
    assert max_rows_per_key(hot.limit(0), "k") == 0
    assert pick_strategy(hot, "k", chunk_rows=n_hot) == "direct"
    assert pick_strategy(hot, "k", chunk_rows=n_hot, extra_rows=1) == "chunked"
    assert pick_strategy(hot, "k", chunk_rows=500) == "chunked"
    a = rolling_mean(hot, "k", ["ts", "event_id"], "value", (10, 200), strategy="auto", chunk_rows=500)
    d = rolling_mean(hot, "k", ["ts", "event_id"], "value", (10, 200), strategy="direct")
    assert a.exceptAll(d).count() == 0 and d.count() == a.count()
    # the chunked plan orders by the global position; the direct one does not
    assert "_bl_pos" in a._jdf.queryExecution().analyzed().toString()
    assert "_bl_pos" not in d._jdf.queryExecution().analyzed().toString()
