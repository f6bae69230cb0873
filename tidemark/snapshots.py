"""Snapshots of a folder: numbered manifests, each put in place by one rename, and what may be deleted.

A manifest says which folders and files make up a table. Data are written under names of their own first and never
changed; the manifest comes last. So a reader sees the state of one manifest as a whole, a writer that dies before the
rename leaves the table as it was, and of two writers that start from the same manifest one is refused.

The file system has to rename without replacing, as HDFS and local disks do.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession


class SnapshotConflict(RuntimeError):
    """Another writer has committed since this one looked."""


class SharedFiles:
    """The few operations on whole files and folders that Spark's readers and writers don't offer."""

    def __init__(self, spark: SparkSession):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._gateway = spark.sparkContext._gateway
        self._java = spark._jvm.java
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._hadoop.Path(path)
        return place.getFileSystem(self._conf), place

    def names(self, folder: str) -> list[str]:
        """What a folder holds; nothing if there is no folder."""
        store, place = self._at(folder)
        return sorted(s.getPath().getName() for s in store.listStatus(place)) if store.exists(place) else []

    def files(self, folder: str) -> list[tuple[str, int, int]]:
        """Path, size and time of change (ms) of each file directly in a folder whose name doesn't start with ``_`` or a dot."""
        store, place = self._at(folder)
        found = store.listStatus(place) if store.exists(place) else []
        return sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in found if s.isFile() and s.getPath().getName()[0] not in "._")

    def size(self, path: str) -> int:
        """Bytes of all files below."""
        store, place = self._at(path)
        return store.getContentSummary(place).getLength()

    def changed(self, path: str) -> float:
        """Time of the last change, in seconds."""
        store, place = self._at(path)
        return store.getFileStatus(place).getModificationTime() / 1000

    def text(self, path: str) -> str:
        store, place = self._at(path)
        stream = store.open(place)
        try:
            size = store.getFileStatus(place).getLen()
            data = self._gateway.new_array(self._gateway.jvm.byte, 0) if not size else stream.readNBytes(size)
            return bytes(data).decode()
        finally:
            stream.close()

    def put_new(self, path: str, text: str) -> bool:
        """Write a file that appears whole and at once; false if there is one of that name."""
        store, place = self._at(path)
        own = self._hadoop.Path(place.getParent(), f".{uuid.uuid4().hex}.tmp")
        out = store.create(own, False)
        out.write(bytearray(text.encode()))
        out.close()
        kind = self._gateway.jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        context = self._hadoop.FileContext.getFileContext(place.toUri() if place.toUri().getScheme() else store.getUri(), self._conf)
        try:
            context.rename(own, place, options)
        except Exception as error:
            store.delete(own, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        store, place = self._at(path)
        store.delete(place, True)


class Snapshots:
    """The manifests of one table, in the folder ``_snapshots`` beside its data."""

    def __init__(self, spark: SparkSession, path: str):
        self.files, self.path = SharedFiles(spark), path.rstrip("/")
        self.folder = f"{self.path}/_snapshots"

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.files.names(self.folder) if n.endswith(".json")]

    def load(self, version: int) -> dict:
        return json.loads(self.files.text(f"{self.folder}/{version:012d}.json"))

    def latest(self) -> tuple[int, dict]:
        """Number and content of the newest manifest; 0 and nothing before the first."""
        versions = self.versions()
        return (versions[-1], self.load(versions[-1])) if versions else (0, {})

    def commit(self, base: int, content: dict) -> int:
        """Make ``content`` the state that follows ``base``."""
        version = base + 1
        if not self.files.put_new(f"{self.folder}/{version:012d}.json", json.dumps(content | {"time": time.time()})):
            raise SnapshotConflict(f"version {version} of {self.path} was committed by another writer")
        return version

    def in_use(self, keep_seconds: float) -> list[dict]:
        """The newest manifest and all that were the newest at some time in the last ``keep_seconds``; before the first, ``{}``."""
        since, found = time.time() - keep_seconds, []
        versions = self.versions()
        for version in reversed(versions):
            found.append(self.load(version))
            if found[-1]["time"] <= since:
                return found
        return found + [{}] if not versions or versions[0] == 1 else found

    def forget(self, keep_seconds: float) -> None:
        """Delete the manifests that :meth:`in_use` doesn't name."""
        for version in self.versions()[: -len(self.in_use(keep_seconds))]:
            self.files.delete(f"{self.folder}/{version:012d}.json")
