"""Incremental silver as a Structured Streaming query.

The bronze landing folder is a file source: Spark's checkpoint records which
files were processed, so each landed (or re-landed) file is picked up exactly
once. Every micro-batch yields the (ticker, trade date) pairs that landed; the
batch function carries just those into silver with :func:`run_silver_changes`.

Batches take effect exactly once. A batch has a name (checkpoint and number) that
its version of silver records, and a time stamp that is written before the work
begins: Spark's replay of a batch that was published does nothing, the replay of
one that failed midway completes or repeats it and finds its report row.

``trigger(availableNow=True)`` gives the scheduled daily run (process what has
landed, then stop); a processing-time trigger keeps it running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.time import utc_now_second
from ..plans.silver import run_silver_changes
from ..session import scratch_path
from ..sources.scan import _filesystem, dataset_exists
from ..sources.versions import applied, apply_pending

BRONZE_SCHEMA = T.StructType([
    T.StructField("Time", T.LongType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.LongType()),
    T.StructField("Trade_date", T.DateType()),
    T.StructField("Ticker", T.StringType()),
])


def batch_stamp(spark: SparkSession, checkpoint: str, epoch_id: int) -> str:
    """The time at which a batch was first tried; the same for every replay."""
    path = f"{checkpoint.rstrip('/')}/batch-stamps/{int(epoch_id)}"
    if not dataset_exists(spark, path):
        store, where = _filesystem(spark, f"{path}.new")
        out = store.create(where, True)
        out.writeBytes(utc_now_second().replace(" ", "T") + "Z")
        out.close()
        store.rename(where, _filesystem(spark, path)[1])
    return spark.read.text(path).first()[0]


def publish_batch(batch: DataFrame, epoch_id: int, bronze_root: str, silver_path: str, report_path: str, checkpoint: str,
                  run_ts_utc: str | None = None, **kw) -> bool:
    """Carries one micro-batch of (Trade_date, Ticker) into silver, once. Returns
    whether it did anything."""
    spark, name = batch.sparkSession, f"{checkpoint}#{int(epoch_id)}"
    apply_pending(spark, silver_path)
    if applied(spark, silver_path, name):
        return False
    stamp = run_ts_utc or batch_stamp(spark, checkpoint, epoch_id)
    changes = batch.selectExpr("Ticker AS ticker", "Trade_date AS trade_date")
    return bool(run_silver_changes(spark, bronze_root, silver_path, report_path, changes, stamp, batch=name, **kw))


def start_silver_stream(spark: SparkSession, bronze_root: str, silver_path: str, report_path: str,
                        run_ts_utc: str | None = None, checkpoint: str | None = None, available_now: bool = True,
                        processing_time: str = "1 hour", max_files_per_trigger: int | None = None, **kw):
    """Start the stream; returns the StreamingQuery. Reports are stamped with the
    batch's own time unless ``run_ts_utc`` is given."""
    checkpoint = checkpoint or scratch_path(spark, "silver-stream-ckpt")
    reader = spark.readStream.schema(BRONZE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    landed = reader.parquet(bronze_root).select("Trade_date", "Ticker")

    def process(batch: DataFrame, epoch_id: int) -> None:
        publish_batch(batch, epoch_id, bronze_root, silver_path, report_path, checkpoint, run_ts_utc, **kw)

    writer = landed.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
