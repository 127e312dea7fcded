"""Sinks: catalog load modes, CSV exports with manifest, table mirroring."""

from .export import (DEFAULT_SIZE_LIMIT, ExportResult, csv_ready, dated_key, debug_path,
                     export_csv, export_manifest, period_label, written_bytes)
from .loaders import LoadMode, key_conflicts, load_table, table_exists
from .mirror import mirror_changes, mirror_jdbc_tables, mirror_tables, select_tables
from .parts import export_csv_parts

__all__ = [
    "DEFAULT_SIZE_LIMIT", "ExportResult", "LoadMode", "csv_ready", "dated_key", "debug_path",
    "export_csv", "export_csv_parts", "export_manifest", "key_conflicts", "load_table", "mirror_changes", "mirror_jdbc_tables", "mirror_tables",
    "period_label", "select_tables", "table_exists", "written_bytes",
]
