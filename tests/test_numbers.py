import math

import pytest

from tidemark.functions import epoch_to_timestamp, exact_mean, parse_float, parse_integer
from pyspark.sql import functions as F

TEXTS = [
    "1", " 2 ", "+3", "-4", "007", "1.0", "1.5", "1e0", "1E5", ".5", "5.", "-.5e-3", "inf", "-inf",
    "Infinity", "nan", "NaN", "1d", "1f", "1L", "0x1p3", "x", "", " ", "1 2", "--1", "1,5",
    "99999999999", "9223372036854775807", "9223372036854775808", "1e400", "\t6\t",
]


def _python(parse, text):
    try:
        return parse(text)
    except ValueError:
        return None


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    rows = df.select("t", parse_integer("t").alias("i"), parse_float("t").alias("f")).collect()
    return {r.t: (r.i, r.f) for r in rows}


@pytest.mark.parametrize("text", TEXTS)
def test_integers_follow_python(parsed, text):
    expected = _python(int, text)
    if expected is not None and expected > 2**63 - 1:
        expected = None  # wider than BIGINT: invalid
    assert parsed[text][0] == expected


@pytest.mark.parametrize("text", TEXTS)
def test_floats_follow_python(parsed, text):
    expected, actual = _python(float, text), parsed[text][1]
    if expected is not None and math.isnan(expected):
        assert math.isnan(actual)
    else:
        assert actual == expected


def test_underscores_are_no_numbers(spark):
    row = spark.range(1).select(parse_integer(F.lit("1_0")), parse_float(F.lit("1_0.5"))).first()
    assert tuple(row) == (None, None)


def test_epoch_keeps_the_repeated_hour(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1699162200,), (1699165800,)], "s long")
        back = df.select(F.unix_seconds(epoch_to_timestamp("s"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r[0] for r in back] == [1699162200, 1699165800]


def test_epoch_out_of_range_is_null(spark):
    df = spark.createDataFrame([(2**63 - 1,), (-(2**63),), (None,), (0,)], "s long")
    back = [r[0] for r in df.select(F.unix_seconds(epoch_to_timestamp("s"))).collect()]
    assert back == [None, None, None, 0]


def test_exact_mean_ignores_row_order(spark):
    values = [0.1, 0.2, 0.7, 1e6, 0.3, None] * 50
    df = spark.createDataFrame([(v,) for v in values], "v double")
    means = {df.repartition(n).agg(exact_mean("v", 2)).first()[0] for n in (1, 3, 7)}
    assert means == {(10 + 20 + 70 + 100_000_000 + 30) / 500}


def test_exact_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([], "v double")
    assert df.agg(exact_mean("v", 2)).first()[0] is None


def test_means_whose_sums_exceed_64_bits(spark):
    df = spark.range(4096).selectExpr("double(4503599627370496) as v", "double(-4503599627370496) as w")
    assert tuple(df.agg(exact_mean("v", 0), exact_mean("w", 0)).first()) == (2.0**52, -(2.0**52))
