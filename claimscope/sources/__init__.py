"""Readers of the claims tables, ingest defaults, writers, and the test-table views."""

from claimscope.sources.defaults import apply_defaults
from claimscope.sources.layout import load_catalog_tables, save_bucketed, save_by_year, with_years
from claimscope.sources.sinks import deliver_csv, read_delivered, write_csv, write_parquet
from claimscope.sources.tables import ClaimsTables, conform, from_frames, load_tables, read_rejected, read_table, table_counts

__all__ = [
    "ClaimsTables",
    "apply_defaults",
    "conform",
    "deliver_csv",
    "from_frames",
    "load_catalog_tables",
    "load_tables",
    "read_delivered",
    "read_rejected",
    "read_table",
    "save_bucketed",
    "save_by_year",
    "table_counts",
    "with_years",
    "write_csv",
    "write_parquet",
]
