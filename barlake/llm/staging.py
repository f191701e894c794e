"""Staged tables in the cluster's shared folder, used to cut lineage and to
read an expensive intermediate more than once."""

from __future__ import annotations

import atexit

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

_made: list[tuple[SparkSession, str]] = []


def fresh(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``. It is deleted when the driver
    program ends, because lazy results may read it until then."""
    path = scratch_path(spark, name)
    _made.append((spark, path))
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: a lost executor costs a re-read
    of shared files, never a recomputation that could differ."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def _delete_all() -> None:
    for spark, path in _made:
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has ended first; the folder's owner cleans up
            return
