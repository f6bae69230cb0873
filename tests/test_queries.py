"""Every registered query against its SQL on the smallest tables."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry
from tidemark.plans import oracle, queries
from tidemark.plans.tables import SCHEMAS, table

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", list(queries.registered()))
def test_same_rows_as_sql(spark, con, name):
    df = spark_entry.queries()[name](spark, str(SF_DIR))
    result = con.execute(spark_entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, map(tuple, df.collect())) == _rows(columns, result.fetchall())


@pytest.mark.parametrize("name", list(SCHEMAS))
def test_tables_have_the_stated_columns(spark, name):
    found = spark.read.parquet(str(SF_DIR / f"{name}.parquet")).dtypes
    assert found == table(spark, str(SF_DIR), name).dtypes


def test_every_query_has_sql():
    assert set(oracle.oracle()) == set(queries.registered()) <= set(spark_entry.queries())
    assert set(oracle.oracle()) <= set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns[:3] == ["window_start", "window_end", "event_type"]
    assert df.count() > 0


def test_no_local_checkpoints_or_row_functions():
    for path in (Path(spark_entry.__file__).parent / "tidemark").rglob("*.py"):
        if path.parent.name == "llm":
            continue
        assert not re.search(r"localCheckpoint|crossJoin|\budf\b|\.rdd\b|toPandas", path.read_text())
