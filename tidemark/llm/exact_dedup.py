"""Exact duplicates by a tree of merges of sorted digest runs.

Each task turns its rows into a sorted run of (digest, smallest row, count), cut into buckets by the
digest's first bytes. In each round the runs of a bucket meet in groups of ``fan_in`` and are merged into one,
which keeps the smallest identifier and adds the counts, until each bucket has one run. There are enough buckets for
``BUCKET_ROWS`` rows in each, so a run's size doesn't grow with the table; copies vanish in the first run they are in, so a group with a
third of all rows costs one entry for each task.

A digest is SHA-256 of the normalised text; every merge also compares the texts' lengths.

Defined cases: null texts count as empty; a null identifier comes after all others; of repeated
rows with the smallest identifier exactly one is kept; an empty table gives an empty one; other columns
are not read. Identifiers are read as BIGINT; texts of any length are digested by Spark where they are read and not moved.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tasks import in_tasks, map_batches
from tidemark.workspace import shared_table

#: One entry of a run. The digest is four numbers made of its bytes in big-endian order, so that they sort as the bytes do.
ENTRY = np.dtype([("d", "<u8", 4), ("id", "<i8"), ("row", "<i8"), ("n", "<i8"), ("size", "<i8")])
#: Rows for each bucket, at 64 bytes an entry.
BUCKET_ROWS = 2_000_000
NO_ID = np.iinfo(np.int64).max


def normalised(text: str | Column) -> Column:
    """White space runs as one space, null as empty."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def merge_runs(runs: list[np.ndarray]) -> np.ndarray:
    """One sorted run of several: of equal digests the smallest (id, row), counts added, sizes compared."""
    both = np.concatenate(runs)
    d = both["d"]
    both = both[np.lexsort((both["row"], both["id"], d[:, 3], d[:, 2], d[:, 1], d[:, 0]))]
    if not len(both):
        return both
    new = np.append(True, (both["d"][1:] != both["d"][:-1]).any(axis=1))
    if (both["size"][1:] != both["size"][:-1])[~new[1:]].any():
        raise ValueError("texts of different length have the same digest")
    first = np.flatnonzero(new)
    merged = both[first]
    merged["n"] = np.add.reduceat(both["n"], first)
    return merged


def exact_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", fan_in: int = 8) -> DataFrame:
    """One row for each row of ``df``: ``key``, ``keep_id``, ``group_size``, ``kept`` and the hex digest ``text_sha256``."""
    spark = df.sparkSession
    value = normalised(text)
    rows = shared_table(
        df.select(
            F.col(key).cast("bigint").alias("id"),
            F.monotonically_increasing_id().alias("row"),
            F.unhex(F.sha2(value, 256)).alias("digest"),
            F.octet_length(value).cast("bigint").alias("size"),
        ),
        "digests",
    )
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // BUCKET_ROWS))

    def runs(batches):
        parts = []
        for batch in batches:
            own = np.zeros(batch.num_rows, ENTRY)
            own["d"] = np.frombuffer(b"".join(batch.column(2).to_pylist()), ">u8").reshape(-1, 4)
            own["id"] = batch.column(0).fill_null(NO_ID).to_numpy()
            own["row"], own["size"] = batch.column(1).to_numpy(), batch.column(3).to_numpy()
            own["n"] = 1
            parts.append(merge_runs([own]))
        if parts:
            run = merge_runs(parts)
            place = (run["d"][:, 0] % buckets).astype(np.int64)
            order = np.argsort(place, kind="stable")
            run, place = run[order], place[order]
            cuts = np.flatnonzero(np.append(True, place[1:] != place[:-1])).tolist()
            part = TaskContext.get().partitionId()
            for a, b in zip(cuts, [*cuts[1:], len(run)]):
                yield pa.RecordBatch.from_arrays([pa.array([int(place[a])], pa.int32()), pa.array([part], pa.int32()), pa.array([run[a:b].tobytes()], pa.binary())], ["bucket", "run", "entries"])

    def merged(pdf):
        run = merge_runs([np.frombuffer(x, ENTRY) for x in pdf["entries"]])
        return pdf.head(1)[["bucket", "run"]].assign(entries=[run.tobytes()])

    def copied(batches):
        for batch in batches:
            for data in batch.column(2).to_pylist():
                run = np.frombuffer(data, ENTRY)
                run = run[run["n"] > 1]
                digests = run["d"].astype(">u8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digests[k : k + 32] for k in range(0, len(digests), 32)], pa.binary()), pa.array(np.where(run["id"] == NO_ID, 0, run["id"]), pa.int64(), mask=run["id"] == NO_ID), pa.array(run["row"], pa.int64()), pa.array(run["n"], pa.int64())],
                    ["digest", "keep_id", "keep_row", "group_size"],
                )

    in_tasks(spark)
    schema = "bucket int, run int, entries binary"
    tree = shared_table(map_batches(rows, runs, schema), "digest-runs")
    left = (tree.agg(F.max("run")).first()[0] or 0) + 1
    while left > 1:
        tree = tree.withColumn("run", (F.col("run") / fan_in).cast("int")).groupBy("bucket", "run").applyInPandas(merged, schema)
        left = -(-left // fan_in)
    copies = map_batches(tree, copied, "digest binary, keep_id bigint, keep_row bigint, group_size bigint")
    return (
        rows.join(copies, "digest", "left")
        .select(
            F.col("id").alias(key),
            F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
            F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )
