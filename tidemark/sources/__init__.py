"""Readers for batch and stream."""

from tidemark.sources.files import (
    csv_lines,
    read_csv_text,
    read_result_table,
    read_table,
    stream_files,
)
from tidemark.sources.kafka import kafka_stream

__all__ = [
    "csv_lines",
    "kafka_stream",
    "read_csv_text",
    "read_result_table",
    "read_table",
    "stream_files",
]
