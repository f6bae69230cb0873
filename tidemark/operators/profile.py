"""Sizes of files and tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.prefix import line_bytes


def file_profile(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Bytes on disk and lines (header included) of every text file under ``paths``, empty ones too."""
    texts = spark.read.text(paths)
    read = texts.groupBy(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_bytes")
    ).agg(F.count(F.lit(1)).alias("line_count"))
    # A scan passes over empty files; only the listing that Spark made for it names them.
    # It writes local paths with an empty host, the scan without one.
    names = [(re.sub(r"^(\w+):///", r"\1:/", path),) for path in texts.inputFiles()]
    listed = spark.createDataFrame(names, "file string")
    zero = F.lit(0).cast("bigint")
    return listed.join(read, "file", "left").select(
        "file", F.coalesce("file_bytes", zero).alias("file_bytes"), F.coalesce("line_count", zero).alias("line_count")
    )


def table_profile(df: DataFrame, group: str, text: str) -> DataFrame:
    """Rows and text bytes, one newline each, per group of a table."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(line_bytes(text)).alias("text_bytes")
    )
