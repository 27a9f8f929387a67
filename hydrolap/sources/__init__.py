"""Readers and writers. Text stays text until the cleaning step types it."""

from .readers import RAW_COLUMNS, CLEAN_COLUMNS, read_clean, read_or_empty, read_raw, read_table, read_text_csv
from .writers import append_log, land, replace_batch, to_json_document, write_csv

__all__ = [
    "CLEAN_COLUMNS", "RAW_COLUMNS", "append_log", "land", "read_clean", "read_or_empty", "read_raw",
    "read_table", "read_text_csv", "replace_batch", "to_json_document", "write_csv",
]
