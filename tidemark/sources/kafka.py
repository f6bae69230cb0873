"""Kafka source. It needs Spark's public Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """One topic; ``starting_offsets`` matters only until there is a checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()
