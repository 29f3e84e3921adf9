"""Readers and writers (O-S*, O-K*)."""

from .readers import (Loaded, Tables, bulk_load, bulk_load_checked, describe_columns, list_files, read_csv,
                      read_events_json, read_log_lines, read_table, register, rows)
from .stored import input_bytes, manifest, manifest_changes, manifest_digest, snapshot, stored
from .writers import (align_to_schema, append_batch, drop_unpublished, insert_into, load_tables, read_batches, write_csv,
                      write_layout, write_parquet)

__all__ = [
    "Loaded", "Tables", "bulk_load", "bulk_load_checked", "describe_columns", "list_files", "read_csv",
    "read_events_json", "read_log_lines", "read_table", "register", "rows", "input_bytes", "manifest", "manifest_changes",
    "manifest_digest", "snapshot", "stored", "align_to_schema", "append_batch", "drop_unpublished", "insert_into",
    "load_tables", "read_batches", "write_csv", "write_layout", "write_parquet",
]
