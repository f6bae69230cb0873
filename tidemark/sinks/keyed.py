"""A table of keyed files: changes rewrite only the files that hold a changed key.

Files are clustered by the first key column and indexed by :mod:`~tidemark.operators.file_index`. :meth:`KeyedTable.apply`
asks the index which files the changed keys can be in, looks at the key columns of those to find which do hold one, merges
the changes with these files' rows, and commits a list of files in which they are replaced. All other files stay
as they are, byte for byte, and are listed again. Readers see the files of one commit; a writer that dies before it
leaves the table as it was.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.file_index import files_that_may_hold, index_files
from tidemark.operators.incremental import apply_changes, latest_version, merge_upsert
from tidemark.snapshots import Snapshots
from tidemark.workspace import shared_table

#: Rows of a file, about.
FILE_ROWS = 1_000_000


class KeyedTable:
    """The table in the folder ``path``; rules for versions and null keys are those of ``apply_changes``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], version: str, file_rows: int = FILE_ROWS):
        self.spark, self.schema, self.keys, self.version, self.file_rows = spark, schema, list(keys), version, file_rows
        self.snapshots = Snapshots(spark, path)
        self.path = self.snapshots.path

    def _rows(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in files])

    def files(self) -> list[str]:
        """Paths of the files, relative to the table's folder."""
        return [f for piece, names in self.snapshots.latest()[1].get("files", {}).items() for f in (f"_data/{piece}/{n}" for n in names)]

    def read(self) -> DataFrame:
        return self._rows(self.files())

    def _write(self, rows: DataFrame) -> dict[str, list[str]]:
        """New files and their entries in the index, beside which they are; nothing is visible yet."""
        piece = uuid.uuid4().hex
        rows = shared_table(rows, "keyed-rows")
        count = rows.count()
        if not count:
            return {}
        parts = -(-count // self.file_rows)
        rows.repartitionByRange(parts, *self.keys).write.parquet(f"{self.path}/_data/{piece}")
        written = self.spark.read.schema(self.schema).parquet(f"{self.path}/_data/{piece}")
        named = written.select(F.col("_metadata.file_name").alias("file"), *self.keys)
        index_files(named, self.keys).withColumn("piece", F.lit(piece)).write.parquet(f"{self.path}/_index/{piece}")
        return {piece: [f.rsplit("/", 1)[1] for f, _, _ in self.snapshots.files.files(f"{self.path}/_data/{piece}")]}

    def create(self, rows: DataFrame) -> int:
        """The first state, with one row for each key."""
        return self.snapshots.commit(0, {"files": self._write(rows.select(*self.schema.names))})

    def _holding(self, files: dict[str, list[str]], wanted: DataFrame) -> list[str]:
        """Files that hold a row of a wanted key."""
        if not files:
            return []
        live = self.spark.createDataFrame([(p, n) for p, names in files.items() for n in names], "piece string, file string")
        index = self.spark.read.parquet(*[f"{self.path}/_index/{p}" for p in files]).join(live, ["piece", "file"])
        index = index.withColumn("file", F.concat_ws("/", F.lit("_data"), "piece", "file"))
        near = files_that_may_hold(index, wanted, self.keys)
        if not near:
            return []
        rows = self._rows(near).select(F.col("_metadata.file_path").alias("path"), *self.keys)
        other = wanted.select(*[F.col(k).alias(f"wanted_{k}") for k in self.keys])
        found = rows.join(other, [F.col(k).eqNullSafe(F.col(f"wanted_{k}")) for k in self.keys], "left_semi")
        last = F.slice(F.split("path", "/"), -2, 2)  # piece and file, names without special characters
        return sorted(f"_data/{r[0]}" for r in found.select(F.array_join(last, "/")).distinct().collect())

    def apply(self, changes: DataFrame, op: str | None = None, delete: str = "D") -> int:
        """Updates, inserts and, where the column ``op`` is ``delete``, deletes; returns the number of the new state.

        The newest change of a key wins; one older than the key's row changes nothing. If another writer commits first this
        raises :class:`~tidemark.snapshots.SnapshotConflict`.
        """
        base, state = self.snapshots.latest()
        files = state.get("files", {})
        newest = shared_table(latest_version(changes, self.keys, self.version), "keyed-changes")
        touched = self._holding(files, newest.select(*self.keys))
        held = self._rows(touched)
        merged = merge_upsert(held, newest, self.keys, self.version) if op is None else apply_changes(held, newest, self.keys, self.version, op, delete)
        left = {p: [n for n in names if f"_data/{p}/{n}" not in set(touched)] for p, names in files.items()}
        return self.snapshots.commit(base, {"files": {p: n for p, n in (left | self._write(merged)).items() if n}})

    def expire(self, keep_seconds: float = 86_400.0) -> None:
        """Delete files that no reader that began in the last ``keep_seconds`` can be reading."""
        used: dict[str, set[str]] = {}
        for state in self.snapshots.in_use(keep_seconds):
            for piece, names in state.get("files", {}).items():
                used.setdefault(piece, set()).update(names)
        files, since = self.snapshots.files, time.time() - keep_seconds
        for piece in files.names(f"{self.path}/_data"):
            folder = f"{self.path}/_data/{piece}"
            if files.changed(folder) > since:
                continue  # perhaps of a writer that hasn't committed yet
            for place, _, _ in files.files(folder):
                if place.rsplit("/", 1)[1] not in used.get(piece, ()):
                    files.delete(place)
            if piece not in used:
                files.delete(folder)
                files.delete(f"{self.path}/_index/{piece}")
        self.snapshots.forget(keep_seconds)
