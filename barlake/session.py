"""Session helpers: a tuned local session for tests/bench and a shared work dir."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_session(master: str | None = None, partitions: int = 8, app: str = "barlake") -> SparkSession:
    """Session used by tests and bench. On a cluster pass master=None and let
    spark-submit decide; every setting here is a plain public Spark conf."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BARLAKE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables and checkpoints.

    Uses the cluster's ``spark.checkpoint.dir``; only when it is unset (local
    tests) a private temporary folder is created and registered.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        current = sc.getCheckpointDir()
        # Spark appends a per-application sub-folder; its parent is the shared root.
        path = current.rsplit("/", 1)[0] if current else None
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store): "
                               "checkpoints and staging copies must survive executor loss")
        path = tempfile.mkdtemp(prefix="barlake-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-path of the shared work dir."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_staged: list[tuple[SparkSession, str]] = []


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared work dir and read back:
    several consumers share one computation and one row order, with column
    pruning, and a lost executor costs a re-read. The copy lives until the
    enclosing :func:`staging_scope` ends, else until the program does."""
    path = scratch_path(df.sparkSession, name)
    _staged.append((df.sparkSession, path))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging_scope() -> Iterator[None]:
    """Deletes the copies staged inside it; for loads that publish their result
    before they return."""
    first = len(_staged)
    try:
        yield
    finally:
        for spark, path in _staged[first:]:
            delete_path(spark, path)
        del _staged[first:]


@atexit.register
def _delete_staged() -> None:
    for spark, path in _staged:
        try:
            delete_path(spark, path)
        except Exception:  # the session has ended first; the folder's owner cleans up
            return


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
