"""Sources and sinks: schemas, path catalog, readers, writers, snapshot tables."""

from strata.sources.io import read_batch, read_or_empty, read_table, table_format, write_batch
from strata.sources.paths import Lake, render_path

__all__ = [
    "Lake",
    "read_batch",
    "read_or_empty",
    "read_table",
    "render_path",
    "table_format",
    "write_batch",
]
