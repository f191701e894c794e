"""Structured Streaming driver for the incremental silver layer."""

from .silver_stream import BRONZE_SCHEMA, start_silver_stream

__all__ = ["BRONZE_SCHEMA", "start_silver_stream"]
