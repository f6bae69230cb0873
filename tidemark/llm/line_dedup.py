"""Lines that repeat across documents, found with levelled sorted runs of line hashes.

Documents are taken in batches of ascending identifiers. A batch's line hashes, one row for each hash with
its smallest document, are merge-joined with the runs written so far: a hash that a run knows belongs to an
earlier document; the others are the batch's own and become a new run. A level with ``fan_in`` runs is merged
into one run of the next level. Runs are tables bucketed and sorted by the hash, so a join
moves the batch only, never the runs.

A line's key is the line without white space (U+0020, U+0009 to U+000D) at both ends, A-Z in lower case; its hash has
128 bits. Keys shorter than ``min_chars`` code points are left alone.

Defined cases: a null or empty text is one empty line; rows with the same identifier count as one document; null
identifiers count as one document that comes last, and so does the identifier 2**63 - 1; identifiers are read as BIGINT; an empty
table gives an empty one; other columns are carried along whatever their names. What a row loses is gathered by identifier and
text, so it is bounded by the row's own lines, however many rows share an identifier; a very long text is one such row.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tasks import map_batches, slices
from tidemark.workspace import run_dir, shared_table

WHITE = " \t\n\x0b\x0c\r"
LAST_ID = (1 << 63) - 1
HASH = ["h1", "h2"]
ROW = ["id", "digest"]


def line_hash(line: str, min_chars: int) -> bytes | None:
    """128 bits of a line's key, or nothing if the key is too short."""
    key = line.strip(WHITE)
    if len(key) < min_chars:
        return None
    return hashlib.blake2b(key.encode().lower(), digest_size=16).digest()


class SortedRuns:
    """Levels of disjoint runs (hash, owner) as bucketed tables in the shared folder."""

    def __init__(self, spark: SparkSession, fan_in: int, buckets: int):
        self.spark, self.fan_in, self.buckets = spark, fan_in, buckets
        self.folder = run_dir(spark, "line-runs")
        self.prefix = f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []
        self.made: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"{self.prefix}_{len(self.made)}"
        writer = rows.repartition(self.buckets, *HASH).sortWithinPartitions(*HASH).write
        writer.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", f"{self.folder}/{name}").format("parquet").saveAsTable(name)
        self.made.append(name)
        return name

    def add(self, rows: DataFrame) -> None:
        """A new run at the first level; full levels are merged upwards."""
        run, level = self._write(rows), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fan_in:
                return
            tables = [self.spark.table(n) for n in self.levels[level]]
            whole = tables[0]
            for other in tables[1:]:
                whole = whole.unionByName(other)
            run = self._write(whole)
            self.levels[level] = []
            level += 1

    def known(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the ``owner`` of their hash in the runs; null where no run has it."""
        owners = []
        for name in [n for level in self.levels for n in level]:
            column = f"owner_{len(owners)}"
            rows = rows.join(self.spark.table(name).withColumnRenamed("owner", column).hint("merge"), HASH, "left")
            owners.append(column)
        owner = F.coalesce(*map(F.col, owners)) if owners else F.lit(None).cast("bigint")
        return rows.withColumn("owner", owner).drop(*owners)

    def close(self) -> None:
        for name in self.made:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _row_keys(key: str, text: str) -> list[Column]:
    """Identifier and a digest of the text. Of two texts of one identifier with the same digest either may lose the other's lines too:
    what a document loses is lost in all of its rows."""
    return [F.coalesce(F.col(key).cast("bigint"), F.lit(LAST_ID)).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("digest")]


def _id_bounds(df: DataFrame, key: str, batches: int) -> list[int]:
    points = [k / batches for k in range(1, batches)]
    found = df.agg(F.percentile_approx(key, points, 10_000)).first()[0] if points else None
    return sorted(set(found or []))


def line_owners(df: DataFrame, key: str, text: str, min_chars: int, batches: int, fan_in: int) -> DataFrame:
    """For each document (``id``) and text (``digest``) in it the hashes of the lines that it loses, packed in one value ``lost``."""
    spark = df.sparkSession

    def hashed(parts):
        for batch in slices(parts):
            sizes, keys = [], []
            for value in batch.column(2).to_pylist():
                found = {line_hash(line, min_chars) for line in (value or "").split("\n")}
                found.discard(None)
                sizes.append(len(found))
                keys.extend(found)
            pair = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            own = [np.repeat(batch.column(k).to_numpy(), sizes) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (*own, pair[:, 0], pair[:, 1])], [*ROW, *HASH])

    rows = df.select(*_row_keys(key, text), F.col(text).cast("string").alias("value"))
    bounds = _id_bounds(df.select(F.col(key).cast("bigint").alias("id")), "id", batches)
    number = sum(((F.col("id") > b).cast("int") for b in bounds), F.lit(0))
    folder = run_dir(spark, "line-hashes")
    map_batches(rows, hashed, "id bigint, digest bigint, h1 bigint, h2 bigint").withColumn("batch", number).write.partitionBy("batch").parquet(folder)
    lines = spark.read.schema("id bigint, digest bigint, h1 bigint, h2 bigint, batch int").parquet(folder)

    runs = SortedRuns(spark, fan_in, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lost = []
    try:
        for batch in range(len(bounds) + 1):
            own = lines.where(F.col("batch") == batch).drop("batch")
            smallest = own.groupBy(*HASH).agg(F.min("id").alias("first"), F.max("id").alias("last"))
            probed = shared_table(runs.known(smallest), "line-batch")
            runs.add(probed.where(F.col("owner").isNull()).select(*HASH, F.col("first").alias("owner")))
            repeated = probed.where(F.col("owner").isNotNull() | (F.col("first") < F.col("last")))
            repeated = repeated.select(*HASH, F.coalesce("owner", "first").alias("owner"))
            lost.append(shared_table(own.join(repeated, HASH).where("id <> owner").select(*ROW, *HASH), "line-losses"))
    finally:
        runs.close()
    whole = lost[0]
    for other in lost[1:]:
        whole = whole.unionByName(other)
    # Equal texts of a document have equal losses: a set, bounded by the lines of the text.
    return whole.groupBy(*ROW).agg(F.collect_set(F.struct(*HASH)).alias("lost"))


def drop_repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 10, batches: int = 4, fan_in: int = 2) -> DataFrame:
    """``df`` with ``row`` (all its columns as they were), ``kept_text``, ``n_lines`` and ``n_dropped``."""

    def applied(parts):
        for batch in slices(parts):
            texts, lines, dropped = [], [], []
            for value, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = (value or "").split("\n")
                lines.append(len(own))
                if gone:
                    pairs = np.array([(g["h1"], g["h2"]) for g in gone], "<i8").tobytes()
                    lost = {pairs[k : k + 16] for k in range(0, len(pairs), 16)}
                    own = [line for line in own if line_hash(line, min_chars) not in lost]
                texts.append("\n".join(own))
                dropped.append(lines[-1] - len(own))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], ["row", "kept_text", "n_lines", "n_dropped"])

    lost = line_owners(df, key, text, min_chars, batches, fan_in)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(text).cast("string").alias("value"), *_row_keys(key, text))
    joined = rows.join(lost, ROW, "left").select("row", "value", "lost")
    schema = T.StructType([joined.schema["row"], T.StructField("kept_text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return map_batches(joined, applied, schema)
