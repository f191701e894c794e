"""Parquet scans: recursive, partition-discovered, date windows, and key
recovery from file paths. Predicates on partition columns become
``PartitionFilters`` (directory pruning), others ``PushedFilters``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.windows import EmptyWindow


def scan_recursive(spark: SparkSession, *paths: str, glob: str = "*.parquet",
                   schema: StructType | None = None, merge: bool = False) -> DataFrame:
    """Every Parquet file below ``paths`` (no partition discovery, so mixed
    directory layouts read without conflict). ``merge``: files may have
    different columns; their footers are then all read."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("mergeSchema", merge)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*paths)


def scan_partitioned(spark: SparkSession, *roots: str, schema: StructType | None = None, base_path: str | None = None,
                     types: Mapping[str, str] | None = None) -> DataFrame:
    """Hive-style ``col=value`` discovery; a schema avoids inference. ``types``
    fixes types that discovery would infer from the directory names: a key that
    is a string keeps leading zeros."""
    options = {"basePath": base_path} if base_path else {}
    if schema is None:
        df = spark.read.options(**options).parquet(*roots)
        wanted = {c.lower(): t for c, t in (types or {}).items()}
        if all(wanted.get(c.lower(), kind) == kind for c, kind in df.dtypes):
            return df
        fields = [StructType.fromDDL(f"`{f.name}` {wanted[f.name.lower()]}").fields[0] if f.name.lower() in wanted else f
                  for f in df.schema.fields]
        schema = StructType(fields)
    return spark.read.schema(schema).options(**options).parquet(*roots)


def _filesystem(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop API."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def dataset_exists(spark: SparkSession, path: str) -> bool:
    """Metadata only; works in any store that Spark reads."""
    store, where = _filesystem(spark, path)
    return store.exists(where)


def day_folders(spark: SparkSession, root: str, date_col: str, lo=None, hi=None) -> list[str]:
    """The ``date_col=YYYY-MM-DD`` folders right below ``root`` in [lo, hi], in
    any case of the name: one listing of that level, nothing deeper."""
    if not dataset_exists(spark, root):
        return []
    store, where = _filesystem(spark, root)
    names = sorted(entry.getPath().getName() for entry in store.listStatus(where))
    mark = f"{date_col}=".lower()
    days = [(n[len(mark):], f"{root.rstrip('/')}/{n}") for n in names if n.lower().startswith(mark)]
    return [path for day, path in days if (lo is None or day >= str(lo)) and (hi is None or day <= str(hi))]


def read_window(spark: SparkSession, root: str, date_col: str, lo=None, hi=None,
                schema: StructType | None = None, types: Mapping[str, str] | None = None) -> DataFrame:
    """Rows whose partition date is in [lo, hi]. Only the folders of those days
    are listed and read; without any, EmptyWindow is raised."""
    folders = day_folders(spark, root, date_col, lo, hi)
    if not folders:
        raise EmptyWindow(f"no {date_col} folders in the window below {root}")
    df = scan_partitioned(spark, *folders, schema=schema, base_path=root, types=types)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(date_col) >= F.lit(str(lo)).cast("date"))
    if hi is not None:
        cond = cond & (F.col(date_col) <= F.lit(str(hi)).cast("date"))
    return df.filter(cond)


def path_key(pattern: str = r"/ticker=([^/]+)") -> Column:
    """Key from the row's source path: URL-decoded, '' (no match) -> NULL."""
    raw = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return F.nullif(F.url_decode(raw), F.lit(""))


def read_with_path_key(spark: SparkSession, *roots: str, key: str = "ticker",
                       pattern: str = r"/ticker=([^/]+)", schema: StructType | None = None,
                       extra: Sequence[Column] = ()) -> DataFrame:
    """Recursive read of a dataset with mixed layouts. The key is the first
    non-null of: the data's own column of that name (in any case), the folder.
    ``extra``: further columns, e.g. of the file's metadata."""
    df = scan_recursive(spark, *roots, schema=schema, merge=True)
    own = [c for c in df.columns if c.lower() == key.lower()]
    sources = [F.col(c).cast("string") for c in own] + [path_key(pattern)]
    return df.select(*[c for c in df.columns if c not in own], F.coalesce(*sources).alias(key), *extra)


def read_with_file_key(spark: SparkSession, root: str, key: str = "Ticker",
                       schema: StructType | None = None) -> DataFrame:
    """Files named ``KEY.parquet``: key = upper-cased file stem."""
    df = scan_recursive(spark, root, schema=schema)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.+)\.parquet$", 1)
    return df.withColumn(key, F.upper(F.nullif(stem, F.lit(""))))
