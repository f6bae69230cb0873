"""Records with line breaks in quoted fields, read by many tasks, against Spark's reader by whole files and Python's."""

import csv
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators.clean import CORRUPT
from tidemark.operators.prefix import text_file_prefix
from tidemark.sources.files import CSV_OPTIONS, read_csv_text, records_as_text, text_schema
from tidemark.sources import records as csv_sources
from tidemark.sources.records import csv_records, line_states, text_lines
from tidemark.workspace import shared_table

COLUMNS = ("a", "b", "c")


@pytest.fixture
def small_blocks(spark):
    """Lines of files from blocks of some hundred bytes."""

    def lines(path, size=300):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            return shared_table(text_lines(spark, str(path)), "lines")
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")

    return lines


def inside(line, state):
    for char in line:
        if state in ("start", "closed") and char == '"':
            state = "quoted"
        elif state == "quoted":
            state = "closed" if char == '"' else "quoted"
        elif state != "quoted":
            state = "start" if char == "," else "plain"
    return state == "quoted"


def test_states_of_lines(spark):
    rng = random.Random(4)
    lines = {"".join(rng.choices('""",a ', k=rng.randint(0, 12))) for _ in range(4000)}
    lines |= {'"' * 300_001, "a," * 300_000 + '"x', '"' + "x" * 2_000_000 + '","'}
    opens, stays = line_states("line")
    df = spark.createDataFrame([(x,) for x in lines], "line string").select("line", opens.alias("opens"), stays.alias("stays"))
    for line, a, b in df.collect():
        assert (a, b) == (inside(line, "start"), inside(line, "quoted")), line[:50]


def whole_files(spark, path):
    rows = spark.read.schema(text_schema(COLUMNS)).options(**CSV_OPTIONS).option("multiLine", True).csv(str(path))
    return rows.withColumn("file_name", F.col("_metadata.file_name")).drop(CORRUPT)


def random_file(rng, rows):
    out = ["a,b,c"]
    for k in range(rows):
        out.append(
            rng.choice(
                [
                    f"{k},x{k},y",
                    f'{k},"q,""{k}' + "\n" * rng.randint(0, 3) + "line" * rng.randint(0, 30) + '",z',
                    "".join(rng.choices('"",a', k=rng.randint(0, 8))),
                    "",
                    f'{k},"' + "\n".join("w" * 50 for _ in range(rng.randint(1, 40))) + '",w',
                    f'{k},"a"b,"c"',
                ]
            )
        )
    return "\n".join([*out, "1,2,3"])


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_of_many_blocks(spark, tmp_path, small_blocks, records, seed):
    rng = random.Random(seed)
    for name in ("a.csv", "b b.csv"):
        (tmp_path / name).write_text(random_file(rng, 150))
    lines = small_blocks(tmp_path)
    assert lines.select("file", "block").distinct().count() > 30
    found = csv_records(lines)
    assert records(records_as_text(found, COLUMNS).drop(CORRUPT)) == records(whole_files(spark, tmp_path))
    want = sum(len(list(csv.reader(open(p)))) - 1 for p in tmp_path.glob("*.csv"))
    assert records_as_text(found, COLUMNS, blank_lines=True).count() == want


def test_a_record_over_many_blocks_and_files_without_breaks(spark, tmp_path, small_blocks, records):
    long = "\n".join(f"line {k} of a long field" for k in range(200))
    (tmp_path / "a.csv").write_text(f'a,b,c\n1,"{long}",x\n2,y,z\n')
    (tmp_path / "b.csv").write_text("a,b,c\n" + "".join(f"{k},b,c\n" for k in range(200)))
    (tmp_path / "c.csv").write_text('"a\nb",b,c\r\n1,"x\r\ny",2\r\n')
    (tmp_path / "d.csv").write_text("")
    found = records_as_text(csv_records(small_blocks(tmp_path)), COLUMNS)
    assert records(found.filter("file_name = 'a.csv'"), *COLUMNS) == [("1", long, "x"), ("2", "y", "z")]
    assert found.filter("file_name = 'b.csv'").count() == 200
    assert records(found.filter("file_name = 'c.csv'"), *COLUMNS) == [("1", "x\ny", "2")]
    only = csv_records(small_blocks(tmp_path / "b.csv"))
    assert only.count() == 201 and only.filter("is_header").count() == 1


def test_budget_cuts_as_in_the_cut_file(spark, tmp_path, records):
    text = random_file(random.Random(9), 60)
    (tmp_path / "in").mkdir()
    (tmp_path / "cut").mkdir()
    (tmp_path / "in" / "a.csv").write_text(text)
    for budget in (200, 1500, 4000):
        kept = text_file_prefix(spark, str(tmp_path / "in"), budget, glob="*.csv")
        spent, used = 0, []
        for line in text.split("\n"):
            spent += len(line) + 1
            if spent > budget:
                break
            used.append(line)
        (tmp_path / "cut" / "a.csv").write_text("\n".join(used))
        got = records_as_text(csv_records(kept.drop("is_header")), COLUMNS)
        assert records(got.drop(CORRUPT)) == records(whole_files(spark, tmp_path / "cut"))


def test_a_quote_that_is_never_closed_is_an_error_beyond_the_bound(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text('a,b,c\n1,"open\n' + "2,3,4\n" * 2000)
    lines = small_blocks(tmp_path, 1000)
    assert csv_records(lines).count() == 2
    for bound in (100, 5000):
        with pytest.raises(PySparkException, match="more than"):
            csv_records(lines, max_bytes=bound).collect()


def test_no_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert read_csv_text(spark, str(tmp_path), multi_line=True).count() == 0


@pytest.mark.parametrize("chunk", [1, 90, 700])
def test_a_block_is_dealt_out_by_chunks(spark, tmp_path, records, monkeypatch, chunk):
    """A file of one block goes to many tasks, and its rows are those of the whole file."""
    monkeypatch.setattr(csv_sources, "CHUNK_BYTES", chunk, raising=False)
    monkeypatch.setattr(csv_sources, "TASK_BYTES", 2000, raising=False)
    written = {}
    monkeypatch.setattr(csv_sources, "shared_table", lambda df, label, *codec: written.setdefault(label, shared_table(df.withColumn("task", F.spark_partition_id()), label, *codec)).drop("task"))
    rng = random.Random(chunk)
    for name in ("a.csv", "b b.csv"):
        (tmp_path / name).write_text(random_file(rng, 150))
    lines = shared_table(text_lines(spark, str(tmp_path)), "lines")
    assert lines.select("file", "block").distinct().count() == 2
    found = csv_records(lines)
    assert records(records_as_text(found, COLUMNS).drop(CORRUPT)) == records(whole_files(spark, tmp_path))
    assert found.filter("is_header").count() == 2
    tasks = [n for _, n in written["csv-pieces"].groupBy("task").agg(F.sum(F.octet_length("text"))).collect()]
    assert len(tasks) > 10 and max(tasks) < 0.25 * sum(tasks)
