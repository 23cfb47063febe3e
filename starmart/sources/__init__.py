"""Raw extracts: what they are called, what they hold, how they are read."""

from starmart.sources.catalog import RAW_SOURCES, RawSource, source_path
from starmart.sources.raw_csv import read_all_raw, read_raw, remove_raw, write_raw

__all__ = [
    "RAW_SOURCES",
    "RawSource",
    "read_all_raw",
    "read_raw",
    "remove_raw",
    "source_path",
    "write_raw",
]
