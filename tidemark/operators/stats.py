"""Grouped statistics of one value column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import exact_mean


def _summary(value: str, scale: int | None = None, digits: int | None = 2) -> list[Column]:
    mean = exact_mean(value, scale)
    return [
        F.count(F.lit(1)).alias(f"{value}_count"),
        (mean if digits is None else F.round(mean, digits)).alias(f"avg_{value}"),
        F.max(value).alias(f"max_{value}"),
        F.min(value).alias(f"min_{value}"),
    ]


def windowed_stats(
    df: DataFrame,
    ts: str = "event_timestamp",
    key: str = "movieId",
    value: str = "rating",
    window: str = "1 minute",
    watermark: str | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Count, rounded mean, max and min of ``value`` per tumbling window and key.

    The same plan serves a batch table and, with ``watermark``, a stream. Each
    task sums up its own rows before the shuffle, so a key that holds much of the
    data costs one row per task and window.
    """
    if watermark is not None:
        df = df.withWatermark(ts, watermark)
    stats = df.groupBy(F.window(ts, window), key).agg(*_summary(value, scale))
    return stats.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in stats.columns if c != "window"],
    )


def key_stats(df: DataFrame, key: str, value: str, scale: int | None = None) -> DataFrame:
    """Count, mean, max and min of ``value`` per key."""
    return df.groupBy(key).agg(*_summary(value, scale, digits=None))


def key_avg(df: DataFrame, key: str, value: str, scale: int | None = None) -> DataFrame:
    """Mean of ``value`` per key."""
    return df.groupBy(key).agg(exact_mean(value, scale).alias(f"avg_{value}"))
