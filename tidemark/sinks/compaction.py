"""Compaction of the batches that an update stream appends: bounded files, bounded reads, one snapshot for each reader.

In update mode a window and key is written again in every batch that changes it. :func:`compact_batches` takes the batches that are
complete, keeps the newest row of each key, and puts the result in the place of the batches by one commit. Rows of windows
that no batch can change any more go to *closed* pieces, which later compactions leave alone; the others are *open* and
are taken up again by the next one. So a row is rewritten while its window is open, and after that once for each
level of pieces (``fan`` pieces become one of the next level), not in every compaction.

A window is closed when it ends ``lateness`` or more before the latest window start seen: event times have reached that
start, so the watermark has passed the window's end. Should a closed window be written again all the same, by a stream with a
new checkpoint, both rows stay and :func:`~tidemark.operators.incremental.latest_version` takes the newer, as before.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.incremental import latest_version
from tidemark.sinks.batches import BATCH
from tidemark.snapshots import SharedFiles, Snapshots

#: Pieces of one level that are merged into one of the next.
FAN = 8
#: Bytes of a file in a merged piece, about.
FILE_BYTES = 128 * 1024 * 1024


def _versions(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])


def _numbers(spark: SparkSession, path: str) -> list[int]:
    prefix = f"{BATCH}="
    return sorted(int(n.removeprefix(prefix)) for n in SharedFiles(spark).names(path) if n.startswith(prefix))


def _read(spark: SparkSession, path: str, schema: T.StructType, pieces: list[str], batches: list[int]) -> DataFrame:
    schema = _versions(schema)
    rows = spark.createDataFrame([], schema)
    if pieces:
        rows = spark.read.schema(schema).parquet(*[f"{path}/{p}" for p in pieces])
    if batches:
        appended = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{BATCH}={n}" for n in batches])
        rows = rows.unionByName(appended) if pieces else appended
    return rows


def read_compacted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of one snapshot and of the batches after it, with their ``batch_id``.

    What is read is fixed when this is called. As with :func:`~tidemark.sinks.batches.read_batches` a key can have several rows.
    """
    path = path.rstrip("/")
    state = Snapshots(spark, path).latest()[1]
    pieces = [p for p, _ in state.get("closed", [])] + state.get("open", [])
    through = state.get("through")
    return _read(spark, path, schema, pieces, [n for n in _numbers(spark, path) if through is None or n > through])


def compact_batches(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: list[str],
    lateness: str = "1 minute",
    start: str = "window_start",
    end: str = "window_end",
    with_newest: bool = False,
    fan: int = FAN,
    file_bytes: int = FILE_BYTES,
) -> int:
    """Replace complete batches by the newest row of each key; returns the snapshot's number.

    The newest batch may be in writing and is left for the next time, unless ``with_newest`` says that the stream has
    stopped. If another compaction commits first this one raises :class:`~tidemark.snapshots.SnapshotConflict` and
    changes nothing. Old files stay for readers until :func:`expire_batches`.
    """
    path = path.rstrip("/")
    snapshots = Snapshots(spark, path)
    base, state = snapshots.latest()
    through = state.get("through")
    batches = [n for n in _numbers(spark, path) if through is None or n > through]
    if not with_newest:
        batches = batches[:-1]
    if not batches:
        return base
    rows = _read(spark, path, schema, state.get("open", []), batches)
    # The columns of times only; a bound from earlier batches holds on.
    reached = rows.agg((F.max(start) - F.expr(f"INTERVAL {lateness}")).alias("bound")).scalar()
    own = f"_compacted/{uuid.uuid4().hex}"
    newest = latest_version(rows, keys, BATCH)
    newest.withColumn("closed", F.coalesce(F.col(end) <= reached, F.lit(False))).write.partitionBy("closed").parquet(f"{path}/{own}")
    made = snapshots.files.names(f"{path}/{own}")
    closed = [tuple(p) for p in state.get("closed", [])]
    if "closed=true" in made:
        closed.append((f"{own}/closed=true", 0))
    closed = _merged(spark, path, schema, closed, fan, file_bytes)
    content = {"closed": closed, "open": [f"{own}/closed=false"] if "closed=false" in made else [], "through": batches[-1]}
    return snapshots.commit(base, content)


def _merged(spark: SparkSession, path: str, schema: T.StructType, pieces: list[tuple[str, int]], fan: int, file_bytes: int) -> list[tuple[str, int]]:
    """The pieces after merging levels that have ``fan`` of them."""
    level = 0
    while any(at >= level for _, at in pieces):
        full = [p for p, at in pieces if at == level]
        if len(full) >= fan:
            size = sum(SharedFiles(spark).size(f"{path}/{p}") for p in full)
            merged = f"_compacted/{uuid.uuid4().hex}/closed=true"
            _read(spark, path, schema, full, []).coalesce(max(1, size // file_bytes)).write.parquet(f"{path}/{merged}")
            pieces = [(p, at) for p, at in pieces if at != level] + [(merged, level + 1)]
        level += 1
    return pieces


def expire_batches(spark: SparkSession, path: str, keep_seconds: float = 86_400.0) -> None:
    """Delete what no reader that began in the last ``keep_seconds`` can be reading, and what no commit took up in that time."""
    path = path.rstrip("/")
    snapshots = Snapshots(spark, path)
    used = snapshots.in_use(keep_seconds)
    named = {p.split("/")[1] for state in used for p in [*(p for p, _ in state.get("closed", [])), *state.get("open", [])]}
    files, since = snapshots.files, time.time() - keep_seconds
    for name in files.names(f"{path}/_compacted"):
        # A folder that was changed lately may belong to a compaction that hasn't committed yet.
        if name not in named and files.changed(f"{path}/_compacted/{name}") <= since:
            files.delete(f"{path}/_compacted/{name}")
    through = min(state["through"] for state in used) if all(used) else None
    for number in _numbers(spark, path):
        if through is not None and number <= through:
            files.delete(f"{path}/{BATCH}={number}")
    snapshots.forget(keep_seconds)
