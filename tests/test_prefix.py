import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tidemark.operators import prefix
from tidemark.operators.prefix import byte_prefix, text_file_prefix, up_to
from tidemark.operators.profile import file_profile, table_profile


def _expected(rows, budget, header_bytes=0):
    spent, kept = header_bytes, []
    for key, text in sorted(rows):
        spent += len((text or "").encode()) + 1
        if spent > budget:
            break
        kept.append(key)
    return kept


def _keys(df):
    return sorted(r.id for r in df.collect())


def _texts(n, seed=1):
    random.seed(seed)
    return [(i, random.choice("aé語🎈") * random.randrange(40)) for i in range(n)]


@pytest.mark.parametrize("budget", [0, 1, 50, 1_000, 5_000, 10**9])
@pytest.mark.parametrize("header_bytes", [0, 60])
def test_against_a_running_sum(spark, budget, header_bytes):
    rows = _texts(300)
    df = spark.createDataFrame(rows, "id long, text string").repartition(7)
    kept = byte_prefix(df, "text", "id", budget, header_bytes)
    assert _keys(kept) == _expected(rows, budget, header_bytes)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string", "int", "double", "date"])
def test_orders_of_any_type(spark, kind):
    rows = _texts(60)
    base = spark.createDataFrame(rows, "id int, text string")
    keys = {
        "timestamp_ntz": "timestamp_ntz'2024-01-01 00:00:00.5' + make_interval(0, 0, 0, id)",
        "timestamp": "timestamp'2024-01-01 00:00:00.5' + make_interval(0, 0, 0, id)",
        "string": "lpad(id, 3, '0')",
        "int": "id",
        "double": "id / 7",
        "date": "date_add(date'2024-01-01', id)",
    }
    df = base.selectExpr("id", "text", f"cast({keys[kind]} as {kind}) as o")
    assert df.schema["o"].dataType.simpleString() == kind
    assert _keys(byte_prefix(df, "text", "o", 700)) == _expected(rows, 700)


def test_the_prefix_ends_at_the_first_overflow(spark):
    rows = [(1, "x" * 9), (2, "x" * 49), (3, "x" * 4)]
    df = spark.createDataFrame(rows, "id long, text string")
    assert _keys(byte_prefix(df, "text", "id", budget=20, header_bytes=2)) == [1]


@pytest.mark.parametrize("budget", [1_000, 4_000])
def test_large_pieces_are_cut_again(spark, budget):
    rows = _texts(400, seed=2)
    df = spark.createDataFrame(rows, "id long, text string")
    kept = byte_prefix(df, "text", "id", budget, pieces=3, max_piece_rows=10)
    assert _keys(kept) == _expected(rows, budget)


def test_each_group_has_its_budget(spark):
    """One group, which may also be the null one, has a third of all rows."""
    rows = _texts(300, seed=3)
    groups = ["a", "a", "b", None, None, "c"]
    table = [(groups[i % 6], i, text) for i, text in rows if i % 6 != 5 or i < 12]
    df = spark.createDataFrame(table, "g string, id long, text string").repartition(5)
    kept = byte_prefix(df, "text", "id", 700, group="g", pieces=3, max_piece_rows=8)
    expected = [
        key
        for g in set(groups)
        for key in _expected([(i, t) for gg, i, t in table if gg == g], 700)
    ]
    assert kept.columns == df.columns
    assert _keys(kept) == sorted(expected)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    texts=st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=12), max_size=40),
    budget=st.integers(0, 300),
)
def test_any_texts(spark, texts, budget):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "id long, text string")
    assert _keys(byte_prefix(df, "text", "id", budget)) == _expected(rows, budget)


def test_without_groups_the_cut_is_a_pushed_filter(spark, tmp_path):
    df = spark.createDataFrame(_texts(100), "id long, text string")
    df.write.parquet(str(tmp_path / "t"))
    kept = byte_prefix(spark.read.parquet(str(tmp_path / "t")), "text", "id", 500).select("id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(id," in plan and "Exchange" not in plan and "text" not in plan.split("ReadSchema")[1]


def test_texts_beyond_the_bound_are_not_read(spark, tmp_path):
    """A budget that takes 300 of 100,000 rows: reading a text behind the first 3,000 is an error."""
    rows = spark.range(100_000).selectExpr("id", "repeat('x', cast(9 + id % 3 as int)) as text")
    rows.repartitionByRange(20, "id").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    text = F.when(F.col("id") < 3_000, F.col("text")).otherwise(F.raise_error(F.lit("read beyond the bound")))
    kept = byte_prefix(stored.withColumn("text", text), "text", "id", 3_300)
    assert kept.select("id").count() == 300
    near = up_to(stored, "id", 700)
    assert "LessThanOrEqual(id,700)" in near._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("step", [1, 0.001, -1])
def test_a_narrow_range_is_found_without_texts(spark, monkeypatch, step):
    """Few bytes of many rows: the range is narrowed several times."""
    monkeypatch.setattr(prefix, "QUANTILES", (0.05, 0.25))
    rows = spark.range(20_000).select((F.col("id") * step).alias("id"), F.when(F.col("id") % 7 == 0, "é").alias("text"))
    expected = [(r.id, r.text) for r in rows.collect()]
    for budget in (0, 1, 5, 100, 900):
        assert _keys(byte_prefix(rows, "text", "id", budget)) == _expected(expected, budget)


def _file_prefix(path, budget):
    with open(path, encoding="utf-8") as f:
        header = f.readline()
        kept, spent = [header.rstrip("\n")], len(header.encode())
        for line in f:
            spent += len(line.encode())
            if spent > budget:
                break
            kept.append(line.rstrip("\n"))
    return kept


@pytest.fixture
def files(tmp_path):
    random.seed(11)
    folder = tmp_path / "files"
    folder.mkdir()
    for name, count in (("small", 5), ("middle", 300), ("large", 2_000)):
        lines = [f"id,text of {name}"]
        lines += [f"{i},{random.choice('aé語') * random.randrange(30)}" for i in range(count)]
        lines[min(3, count)] = ""
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return folder


@pytest.mark.parametrize("budget", [3, 500, 6_000, 30_000, 10**9])
def test_files_cut_at_line_ends(spark, files, budget):
    """Small scan splits, so that the cut falls inside, before and after split bounds."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows = text_file_prefix(spark, str(files), budget).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for path in files.iterdir():
        mine = sorted(r[1:] for r in rows if r.file.endswith(path.name))
        assert [r[2] for r in mine] == _file_prefix(path, budget)
        assert [r[3] for r in mine] == [True] + [False] * (len(mine) - 1)


def test_line_ends_of_two_bytes_count_as_one(spark, tmp_path):
    """Bytes are counted after line ends are decoded."""
    path = tmp_path / "crlf.csv"
    path.write_bytes(b"h\r\n" + b"ab\r\n" * 500 + b"\r\n" * 1500 + b"z\r\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        for budget in (100, 1_500, 2_000, 3_002, 3_003, 3_004, 3_005):
            rows = text_file_prefix(spark, str(path), budget).collect()
            assert [r.line for r in sorted(rows, key=lambda r: r[1:3])] == _file_prefix(path, budget)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("budget", [8, 9, 10, 11])
def test_a_last_line_without_newline(spark, tmp_path, budget):
    path = tmp_path / "open.csv"
    path.write_text("h\n1\n22\n333")
    rows = text_file_prefix(spark, str(path), budget).collect()
    assert [r.line for r in sorted(rows, key=lambda r: r[1:3])] == _file_prefix(path, budget)


def test_null_and_repeated_orders_are_errors(spark):
    df = spark.createDataFrame([(None, "a"), (1, "a")], "id long, text string")
    with pytest.raises(Exception, match="id is null"):
        byte_prefix(df, "text", "id", 3)
    df = spark.createDataFrame([(1, "a")] * 9, "id long, text string")
    with pytest.raises(ValueError, match="unique"):
        byte_prefix(df, "text", "id", 3, max_piece_rows=2)


def test_file_profile(spark, files):
    (files / "empty.csv").write_text("")
    rows = {r.file.rsplit("/")[-1]: r for r in file_profile(spark, str(files)).collect()}
    for path in files.iterdir():
        assert rows[path.name].file_bytes == path.stat().st_size
        assert rows[path.name].line_count == len(path.read_text().splitlines())


def test_table_profile(spark, records):
    df = spark.createDataFrame([("a", "é"), ("a", None), ("b", "xyz")], "g string, t string")
    assert records(table_profile(df, "g", "t")) == [("a", 2, 4), ("b", 1, 4)]


def test_a_missing_path_is_an_error_at_once(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        text_file_prefix(spark, str(tmp_path / "nowhere"))
