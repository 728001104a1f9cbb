"""Scans, sinks, small objects and nested responses."""

from strata.sources.files import (
    count_in_place, literal_table, read_csv, read_parquet, read_with_fallback, text_schema, write_csv, write_parquet,
)
from strata.sources.foreign import CsvScan, UnreadableSource, read_by_header, scan_csv
from strata.sources.objects import ObjectExists, exists, inventory, read_text, size, write_text
from strata.sources.responses import (
    BINDINGS_SCHEMA, CUBE_SCHEMA, TABLE_SERVICE_SCHEMA, flatten_bindings, flatten_cube,
    flatten_table_service, missing_periods, read_responses,
)

__all__ = [
    "BINDINGS_SCHEMA", "CUBE_SCHEMA", "CsvScan", "ObjectExists", "TABLE_SERVICE_SCHEMA", "UnreadableSource", "count_in_place",
    "exists", "flatten_bindings", "flatten_cube", "flatten_table_service", "inventory", "literal_table",
    "missing_periods", "read_by_header", "read_csv", "read_parquet", "read_responses", "read_text",
    "read_with_fallback", "scan_csv", "size", "text_schema", "write_csv", "write_parquet", "write_text",
]
