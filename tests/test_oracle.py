"""Every registered query against its DuckDB oracle (sf0.001 for speed; the
driver repeats this at sf0.01), plus the entry() smoke check."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from barlake import bindings  # noqa: E402
from conftest import SF001  # noqa: E402
from oracle_check import check, duck  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.fixture(scope="module", autouse=True)
def small_chunks(spark):
    """Small enough that the series windows cross several chunk borders."""
    spark.conf.set("barlake.series.chunkRows", "211")
    yield
    spark.conf.unset("barlake.series.chunkRows")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["ticker", "feature_date", "event_time"]


def test_every_query_has_an_oracle():
    assert set(bindings.queries()) == set(bindings.oracle_sql())


@pytest.mark.parametrize("name", sorted(bindings.queries()))
def test_query_matches_oracle(spark, con, name):
    res = check(spark, con, name, SF001)
    assert res["status"] == "EQUAL", res
