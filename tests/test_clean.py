import csv
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import validate
from tidemark.operators.clean import clean_ratings
from tidemark.sources import csv_lines, read_csv_text

LINES = [
    ("1,1,4,5", None),
    ("1,2,3.0", "arity"),
    ("1,3,3.0,4,9", "arity"),
    (" 2 ,4,3.5, 6", None),
    ("1_0,5,3.5,6", "type"),
    ("1,6,nan,6", "range"),
    ("x,7,3.0,6", "type"),
    ("1,8,0.4,6", "range"),
    ("1,9,5.1,6", "range"),
    ("1,14,inf,6", "range"),
    ("1,15,0.5,6", None),
    ("1,16,5.0,6", None),
    ('"1","10","5.0","7"', None),
    ("1,11,3.0,6.0", "type"),
    ("+1,12,1e0,6", None),
    ("99999999999,13,2.0,6", None),
    ("1,17,,6", "type"),
    ('1,"a ""quoted"" word",3.0,6', "type"),
]
VALID = [
    (1, 1, 4.0, 5),
    (1, 10, 5.0, 7),
    (1, 12, 1.0, 6),
    (1, 15, 0.5, 6),
    (1, 16, 5.0, 6),
    (2, 4, 3.5, 6),
    (99999999999, 13, 2.0, 6),
]


@pytest.fixture(params=["file", "lines"])
def rows(request, spark, tmp_path):
    """The same input as a CSV file with a header and as a column of lines."""
    lines = [line for line, _ in LINES]
    if request.param == "file":
        text = "\n".join(["some,other,header,names", *lines[:3], "", *lines[3:]]) + "\n"
        (tmp_path / "ratings.csv").write_text(text, encoding="utf-8")
        return read_csv_text(spark, str(tmp_path))
    return csv_lines(spark.createDataFrame([(line,) for line in lines], "line string"))


def test_valid_rows(rows, records):
    assert records(clean_ratings(rows).valid) == sorted(VALID, key=repr)


def test_types_and_names(rows):
    assert clean_ratings(rows).valid.dtypes == [
        ("userId", "bigint"),
        ("movieId", "bigint"),
        ("rating", "double"),
        ("timestamp", "bigint"),
    ]


def test_reasons(rows):
    reasons = {r.reject_reason: r.row_count for r in clean_ratings(rows).reasons.collect()}
    expected = [reason for _, reason in LINES if reason]
    assert reasons == {reason: expected.count(reason) for reason in set(expected)}


def test_each_reject_has_its_reason(spark, records):
    lines = spark.createDataFrame(LINES, "line string, expected string")
    rejects = clean_ratings(csv_lines(lines)).checked
    assert records(rejects.filter(~F.col("expected").eqNullSafe(F.col(validate.REASON)))) == []


def test_counters_add_up(rows):
    total, valid, skipped = clean_ratings(rows).metrics.first()
    assert (total, valid, skipped) == (len(LINES), len(VALID), len(LINES) - len(VALID))


def test_nan_can_be_kept(rows):
    kept = clean_ratings(rows, keep_nan=True).valid.filter(F.isnan("rating"))
    assert [r.movieId for r in kept.collect()] == [6]


def test_other_bounds(rows, records):
    assert records(clean_ratings(rows, lo=2.0, hi=2.0).valid) == [(99999999999, 13, 2.0, 6)]


def test_blank_lines_count_when_they_are_seen(spark):
    lines = spark.createDataFrame([("",), (None,), ("1,2,3.0,4",)], "line string")
    result = clean_ratings(csv_lines(lines))
    assert tuple(result.metrics.first()) == (3, 1, 2)
    assert [tuple(r) for r in result.reasons.collect()] == [("arity", 2)]


def test_other_columns_stay_with_their_line(spark, records):
    lines = spark.createDataFrame([("a", "1,2,9.0,4"), ("b", "1,2,3.0,4")], "id string, line string")
    rejects = clean_ratings(csv_lines(lines)).rejects
    assert records(rejects, "id", "rating", "reject_reason") == [("a", "9.0", "range")]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_write_counts_in_the_same_pass(rows, spark, tmp_path, fmt, records):
    out = str(tmp_path / "clean")
    counts = clean_ratings(rows).write_valid(out, fmt)
    assert counts == {"total_rows": len(LINES), "valid_rows": 7, "skipped_rows": len(LINES) - 7}
    assert clean_ratings(rows).write_valid(out, fmt) == counts  # replaces, does not append
    schema = "userId long, movieId long, rating double, timestamp long"
    back = spark.read.schema(schema).option("header", True).format(fmt).load(out)
    assert records(back) == sorted(VALID, key=repr)


def test_file_names_are_known(spark, tmp_path, records):
    for name in ("a.csv", "b.csv", "c.txt"):
        (tmp_path / name).write_text("h,h,h,h\n1,1,1.0,1\n", encoding="utf-8")
    assert records(read_csv_text(spark, str(tmp_path)), "file_name") == [("a.csv",), ("b.csv",)]


def test_line_breaks_in_quotes(spark, tmp_path, records):
    (tmp_path / "ratings.csv").write_text('a,b,c,d\n"1\n",2,3.0,4\n5,6,"2.0",7\n')
    rows = read_csv_text(spark, str(tmp_path), multi_line=True)
    assert records(clean_ratings(rows).valid) == [(1, 2, 3.0, 4), (5, 6, 2.0, 7)]


def test_first_broken_rule_is_the_reason(spark, records):
    df = spark.createDataFrame([(1, 1), (-1, -1), (1, -1), (None, 1)], "a int, b int")
    checked = validate.with_reject_reason(df, [("a", F.col("a") > 0), ("b", F.col("b") > 0)])
    assert records(validate.reject_counts(checked)) == [("a", 2), ("b", 1)]
    assert records(validate.valid_rows(checked)) == [(1, 1)]
    assert validate.rejected_rows(validate.with_reject_reason(df, [])).count() == 0


def test_rows_are_converted_once(spark):
    """The conversions must not be repeated under the filter on the reason."""
    lines = spark.createDataFrame([("1,2,3.0,4",)], "line string")
    plan = clean_ratings(csv_lines(lines)).valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast") == 4


def _row_by_row(line):
    """The same rules in plain Python; None for a rejected line."""
    fields = next(csv.reader([line]), [])
    if len(fields) != 4:
        return None
    try:
        user, item, rating, time = int(fields[0]), int(fields[1]), float(fields[2]), int(fields[3])
    except ValueError:
        return None
    return (user, item, rating, time) if 0.5 <= rating <= 5.0 else None


def test_random_lines_against_plain_python(spark, records):
    random.seed(23)
    pieces = ["1", "0", "42", "5", ".5", "4.", "-", "+", "e", "E1", " ", "\t", "x", "nan", "inf", "f", "d", "L"]

    def field():
        text = "".join(random.choice(pieces) for _ in range(random.choice([1, 1, 1, 1, 2, 3])))
        return f'"{text}"' if random.random() < 0.1 else text

    lines = [",".join(field() for _ in range(random.choice([4] * 9 + [3, 5]))) for _ in range(4000)]
    lines += [",".join(random.choice(["1", "5", " 3", "2 "]) for _ in range(4)) for _ in range(500)]
    expected = [row for row in map(_row_by_row, lines) if row]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    assert 300 < len(expected) < 4000
    assert records(clean_ratings(csv_lines(df)).valid) == sorted(expected, key=repr)
