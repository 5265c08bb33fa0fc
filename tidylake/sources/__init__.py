"""Scans: CSV (typed, header-verified, layout variants), Parquet, HTML tables."""

from tidylake.sources.csv import CsvLayout, read_csv, read_layouts, split_rejects
from tidylake.sources.html_tables import extract_tables, parse_tables, table_columns
from tidylake.sources.layouts import discover_layouts, file_headers
from tidylake.sources.mixed import file_layouts, read_mixed
from tidylake.sources.parquet import read_parquet, row_count

__all__ = ["CsvLayout", "read_csv", "read_layouts", "extract_tables", "parse_tables",
           "table_columns", "read_parquet", "discover_layouts", "file_headers",
           "file_layouts", "read_mixed", "row_count", "split_rejects"]
