"""Helpers of the code that runs inside Spark tasks: batches, words, shared files."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: White space of the contracts: space and U+0009 to U+000D.
WORDS = re.compile(r"[^\x20\x09-\x0D]+")

#: Code points between these marks are never split from a text, so offsets stay valid.
ROWS_PER_SLICE = 256


def in_tasks(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, as far as they see that folder."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``df.mapInArrow`` whose workers can import this package."""
    in_tasks(df.sparkSession)
    return df.mapInArrow(function, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_PER_SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows: Python objects are made for one piece at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def ascii_lower(text: str) -> str:
    """``text`` with A-Z in lower case and nothing else changed."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder's address, or of a plain path."""
    if "://" not in uri and not uri.startswith("file:"):
        uri = f"file://{os.path.abspath(uri)}"
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return pafs.FileSystem.from_uri(uri)


class Upload:
    """A file in the shared folder that appears under its name only when it is complete.

    A task that is run again, or twice at once, writes a file of its own and replaces the other
    with the same bytes.
    """

    def __init__(self, folder: str, name: str):
        self.store, base = open_store(folder)
        self.store.create_dir(base, recursive=True)
        self.path = f"{base.rstrip('/')}/{name}"
        self.uri = f"{folder.rstrip('/')}/{name}"
        self.own = f"{self.path}.{uuid.uuid4().hex}.part"
        self.out = self.store.open_output_stream(self.own, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def commit(self) -> str:
        self.out.close()
        self.store.move(self.own, self.path)
        return self.uri
