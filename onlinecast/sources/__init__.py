"""Readers and writers for readings, window records and results."""

from onlinecast.sources.readings import decode_readings, read_readings, rejected_readings
from onlinecast.sources.records import format_window_record, parse_window_record, read_windows, write_windows
from onlinecast.sources.results import append_results, read_results, stream_results, write_results

__all__ = [
    "append_results",
    "decode_readings",
    "format_window_record",
    "parse_window_record",
    "read_readings",
    "read_results",
    "read_windows",
    "rejected_readings",
    "stream_results",
    "write_results",
    "write_windows",
]
