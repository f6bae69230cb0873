"""File sources. A missing path is Spark's own ``PATH_NOT_FOUND`` error, before any work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.clean import CORRUPT, RATING_COLUMNS
from tidemark.sources.records import csv_records, text_lines

FORMATS = ("csv", "json", "parquet")

#: What a line has that is not blank.
NOT_BLANK = "[^\\x00-\\x20]"

# Doubled quotes inside quoted fields; the header line is skipped by position, never matched by name.
CSV_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}


def read_table(
    spark: SparkSession, path: str | list[str], fmt: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """One reader for csv (with header), json lines and parquet.

    Text formats need a schema: inferring one would read all the data twice.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}, but was {fmt!r}")
    if schema is None and fmt != "parquet":
        raise ValueError(f"{fmt} needs a schema")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    return reader.format(fmt).load(path)


def text_schema(columns: Sequence[str]) -> T.StructType:
    """All-string columns plus the raw text of rows with another number of fields."""
    return T.StructType([T.StructField(c, T.StringType()) for c in (*columns, CORRUPT)])


def read_csv_text(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] = RATING_COLUMNS,
    multi_line: bool = False,
    blank_lines: bool = False,
) -> DataFrame:
    """CSV files or directories of ``*.csv`` as text columns, with ``_corrupt_record`` and ``file_name``.

    Nothing is typed or dropped here, so that the cleaner can count what it
    rejects. Blank lines are the exception, as Spark's reader does not see them: ``blank_lines`` adds
    them, from a second scan, as rows without fields. ``multi_line`` allows line breaks in quoted
    fields: lines are written down and joined by :func:`~tidemark.sources.records.csv_records`, with any number of
    tasks for each file; a blank line inside quotes is no row.
    """
    if multi_line:
        return records_as_text(csv_records(text_lines(spark, path)), columns, blank_lines)
    rows = (
        spark.read.schema(text_schema(columns))
        .options(**CSV_OPTIONS)
        .option("pathGlobFilter", "*.csv")
        .csv(path)
        .withColumn("file_name", F.col("_metadata.file_name"))
    )
    if not blank_lines:
        return rows
    lines = spark.read.option("pathGlobFilter", "*.csv").text(path)
    blank = lines.filter(~F.col("value").rlike(NOT_BLANK)).select(
        *[F.lit(None).cast("string").alias(c) for c in columns],
        F.col("value").alias(CORRUPT),
        F.col("_metadata.file_name").alias("file_name"),
    )
    return rows.unionByName(blank)


def records_as_text(records: DataFrame, columns: Sequence[str] = RATING_COLUMNS, blank_lines: bool = False) -> DataFrame:
    """Records of :func:`~tidemark.sources.records.csv_records` in the columns of :func:`read_csv_text`, without headers."""
    kept = records.filter(~F.col("is_header"))
    if not blank_lines:
        kept = kept.filter(F.col("record").rlike(NOT_BLANK))
    named = kept.select(F.element_at(F.split("file", "/"), -1).alias("file_name"), "record")
    return csv_lines(named, "record", columns).select(*columns, CORRUPT, "file_name")


def csv_lines(
    lines: DataFrame, line: str = "line", columns: Sequence[str] = RATING_COLUMNS
) -> DataFrame:
    """The same columns from CSV lines that are already in a table; other columns stay.

    A blank line has no fields and is marked like any other wrong arity.
    """
    fields = F.from_csv(
        F.col(line),
        ", ".join(f"`{c}` string" for c in (*columns, CORRUPT)),
        {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    others = [c for c in lines.columns if c != line]
    blank = F.coalesce(F.length(line), F.lit(0)) == 0
    # As a generator the parse runs once per line; a projection would be
    # repeated below every filter on its fields.
    return lines.select(
        *others, F.when(blank, "").alias("_blank"), F.inline(F.array(fields))
    ).select(*others, *columns, F.coalesce(CORRUPT, "_blank").alias(CORRUPT))


def stream_files(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType | str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A directory as a stream: files are picked up as they arrive."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_result_table(spark: SparkSession, name: str) -> DataFrame:
    """A registered table or the table of a memory sink."""
    return spark.table(name)
