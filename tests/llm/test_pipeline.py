"""The pipeline, stage by stage, on the smallest tables and on odd rows."""

from pathlib import Path

import pytest

import corpus_pipeline
import __spark_entry__ as spark_entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def test_stages_keep_the_columns_and_only_drop(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ids = {r.doc_id for r in docs.collect()}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, now, SF_DIR)
        rows = after.collect()
        assert {r.doc_id for r in rows} <= ids and len(rows) <= len(ids) and len(rows) > 0.5 * len(ids)
        ids = {r.doc_id for r in rows}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
            now = spark.createDataFrame(rows, docs.schema)
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()} == ids


def test_stages_take_odd_rows(spark):
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, 0), (1, "", None, None, 0)], schema)
    for rows in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, SF_DIR).count() <= 3


def test_every_operator_has_a_query():
    names = spark_entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
