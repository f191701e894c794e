"""The series state beside silver: for every key the rows from which any later row
can be computed, so that a run never goes back to the history.

A state has a ``horizon`` (a day). It holds all rows from that day on, and of each
key the last ``rows`` before it, whatever their age: thin and old series cost no
more than busy ones. Rows that silver leaves out for a missing price are in it too;
prices are the filled ones, so a key's last row carries its last known prices."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scan import dataset_exists

#: Days of rows that a state keeps whole: as far back may late data reach without a
#: look at the history.
KEEP_DAYS = 7
HORIZON = "horizon"


def state_path(silver_path: str) -> str:
    return f"{silver_path.rstrip('/')}_state"


def day(value) -> Column:
    return F.lit(str(value)).cast("date")


def read_state(spark: SparkSession, silver_path: str) -> DataFrame | None:
    path = state_path(silver_path)
    return spark.read.parquet(path) if dataset_exists(spark, path) else None


def horizon_of(state: DataFrame | None) -> dt.date | None:
    """The state's horizon; None without a state or without rows (one value)."""
    return state.agg(F.max(HORIZON)).first()[0] if state is not None else None


def last_rows(df: DataFrame, key: str, time: str, rows: int) -> DataFrame:
    """The last ``rows`` rows of every key; each task passes on no more than that
    many of a key."""
    spec = Window.partitionBy(key).orderBy(F.col(time).desc())
    return df.withColumn("_bl_rn", F.row_number().over(spec)).where(F.col("_bl_rn") <= rows).drop("_bl_rn")


def context(state: DataFrame, before, key: str, time: str, rows: int) -> DataFrame:
    """The last ``rows`` rows of every key before the day ``before``, which must not
    lie before the horizon."""
    return last_rows(state.where(F.col("trade_date") < day(before)).drop(HORIZON), key, time, rows)


def trimmed(rows: DataFrame, newest: dt.date, columns: Sequence[str], key: str, time: str, keep: int,
            keep_days: int = KEEP_DAYS) -> DataFrame:
    """A state from rows that hold what it needs: those from ``keep_days`` days
    before ``newest`` on, and the last ``keep`` of each key before."""
    horizon = newest - dt.timedelta(days=keep_days)
    rows = rows.select(*columns)
    recent = rows.where(F.col("trade_date") >= day(horizon))
    older = last_rows(rows.where(F.col("trade_date") < day(horizon)), key, time, keep)
    return recent.unionByName(older).withColumn(HORIZON, day(horizon))
