"""Crash-safe publish of datasets that belong together.

The new rows of every dataset are staged below ``<root>_pending`` with a manifest
that says what replaces what; then the staging is marked ready, applied dataset by
dataset, and recorded as a version below ``<root>_versions``. Until the mark is
there nothing published has changed. After it, every step overwrites from the
staged copy, so an interrupted apply is simply repeated by the next run."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import delete_path
from .scan import _filesystem, dataset_exists
from .sinks import publish

MANIFEST = ("version long, run_ts string, mode string, batch string, step int, dataset string, path string, fields string, "
            "partition_by array<string>, sort_by array<string>, overwrite string, dropped array<string>")


@dataclass
class Change:
    """What a publish does to the dataset at ``path``: ``full`` replaces it,
    ``incremental`` the partitions that ``rows`` has; ``dropped`` are folders that
    go. ``rows`` None: nothing is written."""

    path: str
    rows: DataFrame | None
    partition_by: Sequence[str] = ()
    sort_by: Sequence[str] = ()
    overwrite: str = "incremental"
    dropped: Sequence[str] = field(default_factory=list)


def _pending(root: str) -> str:
    return f"{root.rstrip('/')}_pending"


def _versions(root: str) -> str:
    return f"{root.rstrip('/')}_versions"


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    """The manifests of all applied publishes, one row a dataset."""
    path = _versions(root)
    if not dataset_exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(path)


def last_version(spark: SparkSession, root: str) -> int:
    """Number of the newest version, from the folder names alone; 0 without any."""
    path = _versions(root)
    if not dataset_exists(spark, path):
        return 0
    store, where = _filesystem(spark, path)
    names = [entry.getPath().getName() for entry in store.listStatus(where)]
    return max([int(n.split("=")[1]) for n in names if n.startswith("version=")], default=0)


def apply_pending(spark: SparkSession, root: str) -> bool:
    """Completes a publish that was marked ready, discards one that was not.
    Returns whether there was one to complete."""
    pending = _pending(root)
    ready = dataset_exists(spark, f"{pending}/_READY")
    if ready:
        steps = spark.read.schema(MANIFEST).parquet(f"{pending}/_manifest").orderBy("step").collect()  # one row a dataset
        for step in steps:
            if step.fields is not None:
                schema = StructType.fromJson(json.loads(step.fields))
                rows = spark.read.schema(schema).parquet(f"{pending}/{step.dataset}").select(*schema.names)
                publish(rows, step.path, step.partition_by, step.overwrite, step.sort_by)
            for folder in step.dropped:
                if dataset_exists(spark, folder):
                    delete_path(spark, folder)
        manifest = spark.read.schema(MANIFEST).parquet(f"{pending}/_manifest")
        manifest.drop("version").coalesce(1).write.mode("overwrite").parquet(f"{_versions(root)}/version={steps[0].version}")
        delete_path(spark, f"{pending}/_READY")
    if dataset_exists(spark, pending):
        delete_path(spark, pending)
    return ready


def publish_together(spark: SparkSession, root: str, changes: Mapping[str, Change], run_ts: str, mode: str,
                     batch: str | None = None) -> int:
    """Stages, marks and applies ``changes`` as the next version of ``root``; returns
    its number. ``batch`` names the input for :func:`applied`."""
    apply_pending(spark, root)
    pending, version = _pending(root), last_version(spark, root) + 1
    steps = []
    for n, (name, change) in enumerate(changes.items()):
        if change.rows is not None:
            change.rows.write.parquet(f"{pending}/{name}")
        steps.append((version, run_ts, mode, batch, n, name, change.path, change.rows.schema.json() if change.rows is not None else None,
                      list(change.partition_by), list(change.sort_by), change.overwrite, list(change.dropped)))
    spark.createDataFrame(steps, MANIFEST).coalesce(1).write.parquet(f"{pending}/_manifest")
    mark_ready(spark, f"{pending}/_READY")
    apply_pending(spark, root)
    return version


def mark_ready(spark: SparkSession, path: str) -> None:
    """An empty file: it is there or it is not."""
    store, where = _filesystem(spark, path)
    store.create(where).close()


def applied(spark: SparkSession, root: str, batch: str) -> bool:
    """Whether a version was published from the input ``batch``."""
    return not read_versions(spark, root).where(f"batch = '{batch}'").isEmpty()
