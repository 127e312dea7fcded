"""Sources: parquet tables, fixture adapters, calendar, JSON documents, JDBC."""

from .calendar import data_date_bounds, date_range, date_range_of
from .fixtures import ADAPTERS, adapter, adapter_sql, adapters, with_adapters
from .jdbc import Connection, read_query, read_table, write_table
from .json_docs import (JsonShape, documents_from_text, infer_json_shape, json_object_rows, json_rows,
                        read_json_files, variant_type_to_ddl)
from .sql import run_sql
from .tables import TEST_TABLES, table, tables

__all__ = [
    "ADAPTERS", "Connection", "JsonShape", "documents_from_text", "infer_json_shape", "json_object_rows", "TEST_TABLES", "adapter", "adapter_sql", "adapters",
    "data_date_bounds", "date_range", "date_range_of", "json_rows", "read_json_files",
    "read_query", "read_table", "run_sql", "table", "tables", "variant_type_to_ddl", "with_adapters",
    "write_table",
]
