"""Streaming queries: windowed statistics, and raw landing."""

from __future__ import annotations

from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.events import decode_payload, parse_ratings
from tidemark.operators.stats import windowed_stats
from tidemark.sinks.batches import BatchWriter, first_batch
from tidemark.sinks.jdbc import jdbc_properties, write_jdbc
from tidemark.sources.kafka import kafka_stream
from tidemark.streaming.config import StreamConfig
from tidemark.streaming.late import LateAwareWriter

# Window, lateness and pace of the statistics job.
WINDOW = "1 minute"
WATERMARK = "1 minute"
TRIGGER = {"processingTime": "10 seconds"}
DRAIN = {"availableNow": True}


def rating_stats(records: DataFrame, json_column: str = "json") -> DataFrame:
    """Statistics per minute and movie from JSON rating records."""
    ratings = parse_ratings(records, json_column=json_column)
    return windowed_stats(ratings, window=WINDOW, watermark=WATERMARK)


def start_batches(
    df: DataFrame,
    writer: BatchWriter | LateAwareWriter,
    checkpoint: str,
    trigger: dict | None = None,
    output_mode: str = "update",
) -> StreamingQuery:
    """Feed each micro-batch to ``writer``. Progress and state live in ``checkpoint``.

    So does the number of its first batch, unless the writer has one: a stream with a new checkpoint
    adds to the output of earlier ones.
    """
    if writer.first is None:
        writer = replace(writer, first=first_batch(df.sparkSession, checkpoint))
    return (
        df.writeStream.outputMode(output_mode)
        .foreachBatch(writer)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .start()
    )


def start_memory(df: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    """Drain into the in-memory table ``name``: for tests, as it collects on the driver."""
    return (
        df.writeStream.format("memory")
        .queryName(name)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**DRAIN)
        .start()
    )


def start_landing(
    df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append parsed rows to Parquet; the sink's log makes each batch count exactly once."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .start()
    )


def finish(query: StreamingQuery, timeout: int | None = None) -> None:
    """Wait for the query to end; after ``timeout`` seconds stop it and raise."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"streaming query still running after {timeout} s")


def start_realtime_stats(spark: SparkSession, config: StreamConfig) -> StreamingQuery:
    """The whole job: Kafka ratings to Parquet batches and, if enabled, to the database.

    Unless a path is set, progress is kept beside the output, so a restart goes on where it was.
    Rows in the database carry their ``batch_id``: the highest of a window and key is the newest.
    """
    messages = kafka_stream(spark, config.kafka_servers, config.kafka_topic)
    export = None
    if config.jdbc_enabled:
        export = partial(
            write_jdbc,
            table=config.jdbc_table,
            url=config.jdbc_url,
            properties=jdbc_properties(config.jdbc_user, config.jdbc_password),
        )
    checkpoint = config.checkpoint_path or f"{config.output_path.rstrip('/')}_checkpoint"
    writer = BatchWriter(config.output_path, export, export_batch_id=True)
    return start_batches(rating_stats(decode_payload(messages)), writer, checkpoint)
