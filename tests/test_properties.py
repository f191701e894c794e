"""Properties: upsert idempotence, de-dup uniqueness, no FK
orphans in published gold, results independent of the session time zone."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barlake import bindings
from barlake.operators.clean import dedupe_keep_last
from barlake.operators.constraints import check_constraints
from barlake.operators.upsert import upsert
from conftest import SF001

pairs = st.lists(st.tuples(st.integers(0, 20), st.integers(-5, 5)), max_size=25)


@settings(max_examples=8, deadline=None)
@given(target=pairs, source=pairs)
def test_upsert_idempotent_and_keyed(spark, target, source):
    t = spark.createDataFrame(list(dict(target).items()), "k int, v int")
    s = spark.createDataFrame(list(dict(source).items()), "k int, v int")
    once = upsert(t, s, ["k"])
    twice = upsert(once, s, ["k"])
    got = sorted(tuple(r) for r in once.collect())
    assert got == sorted(tuple(r) for r in twice.collect())
    expected = {**dict(target), **dict(source)}
    assert got == sorted(expected.items())


@settings(max_examples=6, deadline=None)
@given(rows=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=40))
def test_dedupe_unique_and_last(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, v int")
    out = dedupe_keep_last(df, ["k"], ["t", "v"])
    got = {r.k: (r.t, r.v) for r in out.collect()}
    assert out.count() == len(got)
    assert got == {k: max((t, v) for kk, t, v in rows if kk == k) for k in {r[0] for r in rows}}


def test_gold_has_no_orphans(spark):
    dim_t, dim_d, fact, _ = bindings._gold_tables(spark, SF001)
    checks = check_constraints(fact, "fact_prices", pk=["ticker_key", "event_time"],
                               not_null=["open_price", "close_price", "volume"],
                               fks={"ticker_key": (dim_t, "ticker_key"), "date_key": (dim_d, "date_key")})
    assert {r.check_name: r.violations for r in checks.collect()} == {
        "pk:ticker_key,event_time": 0, "not_null:open_price": 0, "not_null:close_price": 0,
        "not_null:volume": 0, "fk:ticker_key": 0, "fk:date_key": 0}


@pytest.mark.parametrize("name", ["silver_full", "feature_view", "time_normalize", "hourly_bars"])
def test_session_zone_independent(spark, name):
    q = bindings.queries()[name]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        a = sorted(map(tuple, q(spark, SF001).collect()))
        spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
        b = sorted(map(tuple, q(spark, SF001).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert a == b and len(a) > 0
