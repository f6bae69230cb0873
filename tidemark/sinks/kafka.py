"""Kafka sink for rows shaped by ``encode_events``."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
