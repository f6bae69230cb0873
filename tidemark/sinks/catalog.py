"""Catalog tables over files: by name, by folder, and replaced in one step.

A published table is a pointer: its rows are written under a folder of their own first, and then the catalog's table is
pointed there by one change of its location. Readers that began before keep the files they have; the next ones see
the new rows as a whole; a writer that dies before the switch leaves the table as it was.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.snapshots import SharedFiles

_NAME = re.compile(r"\w+", re.ASCII)


def _quoted(name: str) -> str:
    """A name as SQL."""
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    """A text as SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database unless it exists."""
    place = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}{place}")


def register_files(
    spark: SparkSession, database: str, tables: Mapping[str, tuple[str, str]]
) -> list[str]:
    """Create each missing table over its CSV files; returns the names created.

    ``tables`` maps a table name to (path, column list in DDL form).
    """
    missing = [t for t in tables if not spark.catalog.tableExists(f"{_quoted(database)}.{_quoted(t)}")]
    for table in missing:
        path, columns = tables[table]
        spark.sql(
            f"CREATE TABLE {_quoted(database)}.{_quoted(table)} ({columns}) "
            f"USING csv OPTIONS (header 'true') LOCATION {_text(path)}"
        )
    return missing


def publish_table(df: DataFrame, database: str, table: str, path: str | None = None) -> int:
    """Replace a table and return its row count as read back from the catalog.

    Each publication is written to a folder of its own under ``path``, or beside the database's tables without one, and
    stays there until :func:`expire_published`. A table with other columns than before is dropped and made
    anew, which is two steps. Raw and cleaned data go under different names, so neither hides the other.
    """
    spark = df.sparkSession
    if path is None:
        path = f"{spark.catalog.getDatabase(_quoted(database)).locationUri.rstrip('/')}/_published/{table}"
    place = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(place)
    name = f"{_quoted(database)}.{_quoted(table)}"
    exists = spark.catalog.tableExists(name)
    if exists and spark.table(name).schema.simpleString() == spark.read.parquet(place).schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(place)}")
    else:
        if exists:
            spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_text(place)}")
    return spark.table(name).agg(F.count(F.lit(1))).first()[0]


def published_place(spark: SparkSession, database: str, table: str) -> str:
    """The folder that a table points to."""
    rows = spark.sql(f"DESCRIBE FORMATTED {_quoted(database)}.{_quoted(table)}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def expire_published(spark: SparkSession, database: str, table: str, keep_seconds: float = 86_400.0) -> list[str]:
    """Delete earlier publications of a table that were written more than ``keep_seconds`` ago; returns their names."""
    files, current = SharedFiles(spark), published_place(spark, database, table)
    folder, own = current.rsplit("/", 1)
    old = [n for n in files.names(folder) if n != own and files.changed(f"{folder}/{n}") <= time.time() - keep_seconds]
    for name in old:
        files.delete(f"{folder}/{name}")
    return old


def folder_tables(spark: SparkSession, folder: str) -> dict[str, str]:
    """Table names by the stems of the ``*.csv`` in a folder (files, or folders of part files), and their paths."""
    found = {n[: -len(".csv")]: f"{folder.rstrip('/')}/{n}" for n in SharedFiles(spark).names(folder) if n.endswith(".csv")}
    wrong = [n for n in found if not _NAME.fullmatch(n)]
    if wrong:
        raise ValueError(f"not a table's name: {', '.join(wrong)}")
    return found


def missing_tables(spark: SparkSession, folder: str, database: str) -> list[str]:
    """Stems of the ``*.csv`` of a folder that the database has no table for."""
    return [t for t in folder_tables(spark, folder) if not spark.catalog.tableExists(f"{_quoted(database)}.{_quoted(t)}")]


def register_folder(
    spark: SparkSession, folder: str, database: str, columns: Mapping[str, str] | None = None, path: str | None = None, only_missing: bool = False
) -> dict[str, int]:
    """Publish every ``*.csv`` of a folder as the table named by its stem; row counts by table.

    ``columns`` maps a table to its columns in DDL form; one that isn't there gets text columns by its header. All
    headers are checked before anything is published: a column that is missing, further or in another place is an
    error. ``only_missing`` leaves tables alone that are there already.
    """
    tables = folder_tables(spark, folder)
    if only_missing:
        tables = {t: tables[t] for t in missing_tables(spark, folder, database)}
    rows = {}
    for table, place in tables.items():
        reader = spark.read.option("header", True).option("escape", '"')
        header = reader.csv(place).columns
        wanted = (columns or {}).get(table)
        if wanted is None:
            schema = ", ".join(f"{_quoted(c)} string" for c in header)
        else:
            schema = wanted
            names = spark.createDataFrame([], wanted).columns
            if [n.lower() for n in names] != [h.lower() for h in header]:
                raise ValueError(f"{place}: the header is {header}, not {names}")
        # Every part file's header is held against the schema as it is read.
        rows[table] = reader.option("enforceSchema", False).schema(schema).csv(place)
    ensure_database(spark, database)
    return {t: publish_table(df, database, t, None if path is None else f"{path.rstrip('/')}/{t}") for t, df in rows.items()}
