"""JSON event records: parse into typed rows, and encode rows as records."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import epoch_to_timestamp

# Field names and types of a rating record.
RATING_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("movieId", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)


def parse_json_records(
    records: DataFrame, schema: T.StructType, json_column: str = "json"
) -> DataFrame:
    """The fields of one JSON object per row; only rows that carry all of them are kept.

    Text that is no such object parses to nulls and is dropped with the
    incomplete rows. ``inline`` keeps the parse below the filter: as a plain
    projection Spark would push the filter under it and parse every record twice.
    """
    parsed = records.select(F.inline(F.array(F.from_json(json_column, schema))))
    complete = reduce(and_, (F.col(f.name).isNotNull() for f in schema))
    return parsed.filter(complete)


def parse_ratings(
    records: DataFrame,
    schema: T.StructType = RATING_SCHEMA,
    *,
    json_column: str = "json",
    time_field: str = "timestamp",
    bounds: tuple[str, float, float] | None = None,
) -> DataFrame:
    """Typed events from JSON text, for batch and stream alike.

    ``time_field`` (epoch seconds) is renamed ``event_time`` and also given as
    the timestamp ``event_timestamp``. ``bounds`` = (column, lo, hi) adds an
    inclusive range check.
    """
    events = parse_json_records(records, schema, json_column).withColumnRenamed(
        time_field, "event_time"
    )
    if bounds is not None:
        column, lo, hi = bounds
        events = range_filter(events, column, lo, hi)
    return events.withColumn("event_timestamp", epoch_to_timestamp("event_time"))


def range_filter(df: DataFrame, column: str, lo: float = 0.5, hi: float = 5.0) -> DataFrame:
    """Rows whose ``column`` lies in [lo, hi]; null and NaN do not."""
    return df.filter(F.col(column).between(lo, hi))


def encode_events(events: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Message-shaped rows: ``key`` as text and ``columns`` as a JSON object in ``value``."""
    return events.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*columns)).alias("value"),
    )


def decode_payload(messages: DataFrame, column: str = "value") -> DataFrame:
    """Message payload bytes as the single text column ``json``."""
    return messages.select(F.col(column).cast("string").alias("json"))
