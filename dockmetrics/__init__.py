"""Dock-fleet analytics on Spark DataFrames and Structured Streaming."""

from dockmetrics.model import RECORD_SCHEMAS, RESULT_TABLES, TableSpec, conform, require_columns
from dockmetrics.session import build_session, shared_folder

__all__ = [
    "RECORD_SCHEMAS",
    "RESULT_TABLES",
    "TableSpec",
    "build_session",
    "conform",
    "require_columns",
    "shared_folder",
]
