"""Writers for batch results and micro-batches."""

from tidemark.sinks.batches import BatchWriter, read_batches
from tidemark.sinks.catalog import ensure_database, publish_table, register_files, register_folder
from tidemark.sinks.files import append_parquet, preview, write_csv, write_parquet
from tidemark.sinks.jdbc import jdbc_properties, write_jdbc
from tidemark.sinks.kafka import write_kafka

__all__ = [
    "BatchWriter",
    "append_parquet",
    "ensure_database",
    "jdbc_properties",
    "preview",
    "publish_table",
    "read_batches",
    "register_files",
    "register_folder",
    "write_csv",
    "write_jdbc",
    "write_kafka",
    "write_parquet",
]
