"""Structured Streaming: incremental ingestion of a folder of JSON files."""

from .json_ingest import ingest_json_folder, read_ingested

__all__ = ["ingest_json_folder", "read_ingested"]
