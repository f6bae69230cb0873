"""Micro-batch sink: every batch of a stream lands once, however often it is retried."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"


@dataclass(frozen=True)
class BatchWriter:
    """A ``foreachBatch`` function: Parquet always, then ``export`` if given.

    The batch replaces its own ``batch_id`` partition, so a retry leaves one copy, and a batch
    without rows leaves nothing. ``export`` gets the rows read back from there, with their
    ``batch_id`` if ``export_batch_id``: the stateful plan runs once per batch, and both sinks see
    the same rows.

    Batches are numbered from ``first``. A stream with a new checkpoint counts from 0 again; another
    ``first`` (see :func:`first_batch`) keeps it from replacing what an earlier one wrote.
    """

    path: str
    export: Callable[[DataFrame], None] | None = None
    files_per_batch: int | None = None
    first: int | None = None
    export_batch_id: bool = False

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        number = (self.first or 0) + batch_id
        if self.files_per_batch is not None:
            # A shuffle of the few result rows; coalescing would narrow the stateful stage itself.
            batch = batch.repartition(self.files_per_batch)
        seen = Observation()
        (
            batch.observe(seen, F.count(F.lit(1)).alias("n"))
            .withColumn(BATCH, F.lit(number).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH)
            .parquet(self.path)
        )
        # Where the planner saw that there are no rows, nothing was observed.
        if self.export is not None and seen.get.get("n"):
            rows = batch.sparkSession.read.schema(batch.schema).parquet(f"{self.path}/{BATCH}={number}")
            if self.export_batch_id:
                rows = rows.withColumn(BATCH, F.lit(number).cast("bigint"))
            self.export(rows)


def first_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the first batch of the stream whose progress is in ``checkpoint``, and kept there.

    It is the time of the first start in nanoseconds: batches of a later checkpoint have higher
    numbers than those of an earlier one, so the highest number of a key is its newest row.
    """
    path = f"{checkpoint.rstrip('/')}/first_batch"
    stored = _stored(spark, path)
    if stored is None:
        start = spark.range(1, numPartitions=1).select(F.lit(str(time.time_ns())).alias("value"))
        start.write.mode("overwrite").text(path)
        stored = _stored(spark, path)
    return int(stored)


def _stored(spark: SparkSession, path: str) -> str | None:
    try:
        row = spark.read.text(path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row and row[0]


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches under ``path``, with their ``batch_id``. In update mode a key is in several."""
    versions = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(versions).parquet(path)
