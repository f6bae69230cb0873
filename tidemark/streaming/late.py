"""Windowed statistics of a stream that count late rows, keep them and can take them in again.

Spark's stateful aggregation drops rows whose window the watermark has passed; only a number in the progress tells of them.
Here each micro-batch is split before it is aggregated: a row is late if its window ends at or before the watermark, which is
the latest event time of all earlier batches less ``delay``. Both kinds are summed up per window and key into *parts*,
one set for each batch, and late rows are also kept as they are. A result is a merge of parts:
:func:`on_time_stats` without the late rows, :func:`reconciled_stats` with them, which equals the statistics of all rows as
one batch table, in whatever order they came.

No state store is needed, since the parts are the state. A batch is judged by the progress that the one before has left, and
writes to places of its own, progress last, so a batch that is run again after a crash gives the same files.

Defined cases: rows without event time are in no window, as in batch; rows without key form a group; nothing is late in
the first batch; a batch without rows passes the progress on.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import exact_sum
from tidemark.sinks.batches import BATCH
from tidemark.snapshots import SharedFiles

#: Progress files that are kept; a batch needs the one before it.
KEPT = 100
LATE = "late"


@dataclass(frozen=True)
class LateAwareWriter:
    """A ``foreachBatch`` function that leaves parts, late rows and its progress under ``path``.

    The source is read once for a batch, and once more if some of its rows are late. ``scale``: as in
    :func:`~tidemark.functions.exact_sum`, for sums that don't depend on the order of rows. Batches are numbered from ``first``,
    as by :class:`~tidemark.sinks.batches.BatchWriter`.
    """

    path: str
    ts: str = "event_timestamp"
    key: str = "movieId"
    value: str = "rating"
    window: str = "1 minute"
    delay: str = "1 minute"
    scale: int | None = None
    first: int | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, number = batch.sparkSession, (self.first or 0) + batch_id
        before = seen_before(spark, self.path, number)
        timed = batch.where(F.col(self.ts).isNotNull())
        newest = F.max(F.unix_micros(F.col(self.ts).cast("timestamp"))).alias("newest")
        sums = timed.groupBy(F.window(self.ts, self.window), F.col(self.key).alias("key")).agg(*_parts(self.value, self.scale), newest)
        # All rows of a window are late or none is.
        late = self._passed(F.col("window.end"), before).alias(LATE)
        parts = sums.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "key", *PARTS, "newest", late)
        _replace(parts, f"{self.path}/parts", number)
        written = spark.read.schema(parts.schema).parquet(f"{self.path}/parts/{BATCH}={number}")
        found = written.agg(F.max("newest").alias("seen"), F.count(F.when(F.col(LATE), 1)).alias("late")).first()
        if found["late"]:
            _replace(timed.where(self._late(before)), f"{self.path}/late", number)
        seen = max((t for t in (before, found["seen"]) if t is not None), default=None)
        _leave(spark, self.path, number, seen)

    def _passed(self, end: Column, before: int | None) -> Column:
        """Whether the watermark is at ``end`` or beyond; it depends on earlier batches alone."""
        if before is None:
            return F.lit(False)
        return end.cast("timestamp") <= F.timestamp_micros(F.lit(before)) - F.expr(f"INTERVAL {self.delay}")

    def _late(self, before: int | None) -> Column:
        if before is None:
            return F.lit(False)
        # Windows begin at whole multiples of their length.
        length = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {self.window}"))
        at = F.unix_micros(F.col(self.ts).cast("timestamp"))
        return self._passed(F.timestamp_micros(at - F.pmod(at, length) + length), before)


#: Number of rows, of values, their sum and extremes.
PARTS = ["n", "filled", "total", "highest", "lowest"]


def _parts(value: str, scale: int | None) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.count(value).alias("filled"),
        (F.sum(F.col(value).cast("double")) if scale is None else exact_sum(value, scale)).alias("total"),
        F.max(value).alias("highest"),
        F.min(value).alias("lowest"),
    ]


def _replace(rows: DataFrame, path: str, number: int) -> None:
    """Put ``rows`` in the place of what an earlier run of the batch has left there."""
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")


def seen_before(spark: SparkSession, path: str, number: int) -> int | None:
    """Latest event time, in microseconds, of all batches before ``number``."""
    files, folder = SharedFiles(spark), f"{path}/_progress"
    earlier = [n for n in files.names(folder) if n.endswith(".json") and int(n.removesuffix(".json")) < number]
    return json.loads(files.text(f"{folder}/{earlier[-1]}"))["seen"] if earlier else None


def _leave(spark: SparkSession, path: str, number: int, seen: int | None) -> None:
    files, folder = SharedFiles(spark), f"{path}/_progress"
    files.put_new(f"{folder}/{number:020d}.json", json.dumps({"seen": seen}))
    for name in [n for n in files.names(folder) if n.endswith(".json")][:-KEPT]:
        files.delete(f"{folder}/{name}")


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """Parts of all batches; ``late`` tells those of late rows."""
    return spark.read.parquet(f"{path}/parts")


def late_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """Late rows of all batches as they came, with ``batch_id``; None if there are none."""
    return spark.read.parquet(f"{path}/late") if SharedFiles(spark).names(f"{path}/late") else None


def on_time_stats(parts: DataFrame, key: str = "movieId", value: str = "rating", scale: int | None = None) -> DataFrame:
    """The statistics without late rows, with the columns of :func:`~tidemark.operators.stats.windowed_stats`."""
    return _merged(parts.where(~F.col(LATE)), key, value, scale, [])


def reconciled_stats(parts: DataFrame, key: str = "movieId", value: str = "rating", scale: int | None = None) -> DataFrame:
    """The statistics of all rows, and as ``late_count`` how many of them were late."""
    late = F.sum(F.when(F.col(LATE), F.col("n")).otherwise(0)).alias("late_count")
    return _merged(parts, key, value, scale, [late])


def _merged(parts: DataFrame, key: str, value: str, scale: int | None, more: Sequence[Column]) -> DataFrame:
    units = 1.0 if scale is None else float(10**scale)
    mean = F.sum("total").cast("double") / F.nullif(F.sum("filled").cast("double") * F.lit(units), F.lit(0.0))
    return parts.groupBy("window_start", "window_end", F.col("key").alias(key)).agg(
        F.sum("n").alias(f"{value}_count"),
        F.round(mean, 2).alias(f"avg_{value}"),
        F.max("highest").alias(f"max_{value}"),
        F.min("lowest").alias(f"min_{value}"),
        *more,
    )
