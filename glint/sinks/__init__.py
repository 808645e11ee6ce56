"""Sinks (K1-K7)."""

from .buckets import bucketed_table, write_bucketed
from .commit import finished, staged_write
from .writers import (
    build_tables,
    form_json,
    write_csv,
    write_json,
    write_partitioned,
    write_sorted,
    write_table,
)

__all__ = ["bucketed_table", "build_tables", "finished", "form_json", "staged_write", "write_bucketed", "write_csv", "write_json", "write_partitioned", "write_sorted", "write_table"]
