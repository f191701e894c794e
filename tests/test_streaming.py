"""Streaming incremental silver == batch full silver, across two landings and
a re-delivered day."""

from pyspark.sql import functions as F

from barlake.plans import silver
from barlake.session import table
from barlake.sources.scan import scan_partitioned
from barlake.streaming import start_silver_stream
from conftest import SF001
from test_pipeline import RUN_TS, _land, _silver_rows


def test_stream_matches_full(spark, tmp_root):
    events = table(spark, SF001, "events")
    bronze, streamed, full = f"{tmp_root}/bronze", f"{tmp_root}/silver_stream", f"{tmp_root}/silver_full"
    report, ckpt = f"{tmp_root}/report", f"{tmp_root}/ckpt"
    _land(spark, bronze, events.filter(F.col("ts") < F.lit("2024-01-12").cast("timestamp_ntz")))
    q = start_silver_stream(spark, bronze, streamed, report, RUN_TS, checkpoint=ckpt, strategy="chunked", chunk_rows=257, lookback_days=3)
    q.awaitTermination()
    # second landing: later days plus day 2024-01-11 re-delivered
    _land(spark, bronze, events.filter(F.col("ts") >= F.lit("2024-01-11").cast("timestamp_ntz")))
    q = start_silver_stream(spark, bronze, streamed, report, RUN_TS, checkpoint=ckpt, strategy="chunked", chunk_rows=257, lookback_days=3)
    q.awaitTermination()
    silver.run_silver(spark, bronze, full, report, "full", "2024-01-30", RUN_TS, strategy="chunked", chunk_rows=257)
    assert _silver_rows(spark, streamed) == _silver_rows(spark, full)
    assert scan_partitioned(spark, streamed).count() > 0
