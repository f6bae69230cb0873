"""Increments by a ledger of processed files and keys, in place of one high-water mark.

A file is processed once; a row is picked up once, whatever its time: a late row, one of two with equal times, and a row
that arrives again in a later file (a replay) are told apart by their keys, not by the clock. For each processed file the
ledger has the file's name, size and time of change, and its entry in the index of :mod:`~tidemark.operators.file_index`. Keys of new
files are looked up in that index, and only processed files that they are not ruled out of are read again, their key columns alone.

:meth:`Ledger.pending` gives the new rows, :meth:`Increment.commit` enters their files. What dies in between is given again
by the next call, with the same number: write it under that number, as
:class:`~tidemark.sinks.batches.BatchWriter` does, and it lands once. Of two processes with the same increment one
commits; the other gets :class:`~tidemark.snapshots.SnapshotConflict`.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.file_index import files_that_may_hold, index_files
from tidemark.snapshots import Snapshots
from tidemark.workspace import shared_table


@dataclass(frozen=True)
class Increment:
    """Rows to pick up; ``number`` is that of the ledger's state after :meth:`commit`."""

    ledger: Ledger
    rows: DataFrame
    files: list[tuple[str, int, int]]
    number: int

    def commit(self) -> None:
        self.ledger._enter(self)


class Ledger:
    """The processed Parquet files of the folder ``source``; ``path`` is the ledger's own folder."""

    def __init__(self, spark: SparkSession, path: str, source: str, schema: T.StructType, keys: list[str]):
        self.spark, self.source, self.schema, self.keys = spark, source.rstrip("/"), schema, list(keys)
        self.snapshots = Snapshots(spark, path)

    def _entries(self, state: dict) -> DataFrame | None:
        pieces = state.get("entries", [])
        return self.spark.read.parquet(*[f"{self.snapshots.path}/{p}" for p in pieces]) if pieces else None

    def _named(self, files: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*files)

    def pending(self) -> Increment | None:
        """Rows of new files without those whose key was picked up before; None if there are no new files.

        Of rows with the same key in the new files the one with the least values is given. A null key is a key. A
        processed file that has changed since is an error, as the rows it had can't be known any more.
        """
        base, state = self.snapshots.latest()
        present = self.snapshots.files.files(self.source)
        entries = self._entries(state)
        if entries is not None and present:
            known = self.spark.createDataFrame(present, "file string, size bigint, changed bigint")
            done = entries.select("file", F.col("size").alias("was"), F.col("changed").alias("at"))
            new = known.join(done, "file", "left").where("was IS NULL OR was <> size OR at <> changed").collect()
            altered = [r.file for r in new if r.was is not None]
            if altered:
                raise ValueError(f"processed files have changed: {', '.join(altered[:3])}")
            present = sorted((r.file, r.size, r.changed) for r in new)
        if not present:
            return None
        rows = self._named([f for f, _, _ in present])
        others = [c for c in rows.columns if c not in self.keys]
        once = rows.groupBy(*self.keys).agg(F.min(F.struct(*others)).alias("rest")) if others else rows.distinct()
        once = once.select(*[F.col(f"rest.{c}").alias(c) if c in others else F.col(c) for c in rows.columns])
        once = shared_table(once, "increment")
        again = files_that_may_hold(entries, once.select(*self.keys), self.keys) if entries is not None else []
        # A processed file that was deleted since can't be looked at.
        there = {f for f, _, _ in self.snapshots.files.files(self.source)}
        missing = [f for f in again if f not in there]
        if missing:
            raise FileNotFoundError(f"processed files that may hold keys of new rows are gone: {', '.join(missing[:3])}")
        if again:
            old = self._named(again).select(*[F.col(k).alias(f"old_{k}") for k in self.keys])
            same = [F.col(k).eqNullSafe(F.col(f"old_{k}")) for k in self.keys]
            once = once.join(old, same, "left_anti")
        return Increment(self, once, present, base + 1)

    def _enter(self, increment: Increment) -> None:
        rows = self._named([f for f, _, _ in increment.files]).select(F.col("_metadata.file_path").alias("path"), *self.keys)
        # Names as Spark gives them: read each file's own, so that escaping is the same on both sides.
        files = self.spark.createDataFrame(increment.files, "file string, size bigint, changed bigint").withColumn("name", F.element_at(F.split("file", "/"), -1))
        named = rows.withColumn("name", F.url_decode(F.replace(F.element_at(F.split("path", "/"), -1), F.lit("+"), F.lit("%2B"))))
        piece = f"_entries/{uuid.uuid4().hex}"
        index = index_files(named.drop("path"), self.keys, "name")
        # Files without rows have no entry in the index, but are processed as well.
        files.join(index, "name", "left").drop("name").write.parquet(f"{self.snapshots.path}/{piece}")
        state = self.snapshots.load(increment.number - 1) if increment.number > 1 else {}
        self.snapshots.commit(increment.number - 1, {"entries": [*state.get("entries", []), piece]})
