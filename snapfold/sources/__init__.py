"""Sources and tables."""

from snapfold.sources.keyed import Change, KeyedTable, fold_totals, retraction
from snapfold.sources.snapshots import (
    FILE_ORDER,
    PROVENANCE,
    UTF_8,
    WINDOWS_1252,
    Dialect,
    decode_windows_1252,
    encode_windows_1252,
    list_files,
    read_files,
    read_headers,
    read_snapshots,
)
from snapfold.sources.tables import Lake

__all__ = [
    "Change",
    "Dialect",
    "FILE_ORDER",
    "KeyedTable",
    "Lake",
    "PROVENANCE",
    "UTF_8",
    "WINDOWS_1252",
    "decode_windows_1252",
    "encode_windows_1252",
    "fold_totals",
    "list_files",
    "read_files",
    "read_headers",
    "read_snapshots",
    "retraction",
]
