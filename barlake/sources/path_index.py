"""An index of a dataset's files by what their paths say, from one listing: files of a
window are chosen before any of them is opened, in whatever mix of layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_index(spark: SparkSession, root: str, date_col: str = "trade_date", key: str = "ticker",
               glob: str = "*.parquet") -> DataFrame:
    """(file, day, key, bytes, written) of every file below ``root``: day and key from
    ``date_col=`` and ``key=`` folders at any depth, in any case of the name, null
    without one. The listing is Spark's; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)

    def part(name: str):
        return F.nullif(F.url_decode(F.regexp_extract("path", f"(?i)/{name}=([^/]+)/", 1)), F.lit(""))

    return files.select(F.col("path").alias("file"), part(date_col).try_cast("date").alias("day"),
                        part(key).alias("key"), F.col("length").alias("bytes"), F.col("modificationTime").alias("written"))


def files_in_window(index: DataFrame, lo=None, hi=None, keys=None) -> list[str]:
    """The files that may hold rows of days in [lo, hi] (and of ``keys``): those
    whose path says so, and those whose path says nothing."""
    cond = F.lit(True)
    if lo is not None:
        cond &= F.col("day").isNull() | (F.col("day") >= F.lit(str(lo)).cast("date"))
    if hi is not None:
        cond &= F.col("day").isNull() | (F.col("day") <= F.lit(str(hi)).cast("date"))
    if keys is not None:
        cond &= F.col("key").isNull() | F.col("key").isin(list(keys))
    return sorted(r.file for r in index.where(cond).select("file").toLocalIterator())
