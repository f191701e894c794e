"""Sources and sinks (Parquet on a shared file system / object store)."""

from .scan import (
    dataset_exists,
    path_key,
    read_window,
    read_with_file_key,
    read_with_path_key,
    scan_partitioned,
    scan_recursive,
)
from .sinks import append, land_bronze, publish, staged_overwrite

__all__ = [
    "dataset_exists", "path_key", "read_window", "read_with_file_key", "read_with_path_key",
    "scan_partitioned", "scan_recursive", "append", "land_bronze", "publish", "staged_overwrite",
]
