"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace what ``path`` held."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Replace what ``path`` held; every part file starts with the header line. Texts keep their outer spaces."""
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").option("header", True).option("escape", '"').options(**spaces).csv(path)


def preview(df: DataFrame, rows: int = 20) -> None:
    """Print the first rows."""
    df.show(rows)
