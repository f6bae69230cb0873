import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators.events import (
    decode_payload,
    encode_events,
    parse_ratings,
    range_filter,
)

GOOD = '{"userId":1,"movieId":10,"rating":5.0,"timestamp":1704067200}'

DROPPED = [
    "not json",
    "",
    None,
    "null",
    GOOD[:-1],
    f"[{GOOD}]x",
    '[{"userId":1},1]',
    GOOD.replace("5.0", '"5.0"'),
    GOOD.replace('"userId":1', '"userId":"1"'),
    GOOD.replace("1704067200", '"1704067200"'),
    GOOD.replace('"userId":1', '"userId":1.5'),
    GOOD.replace("1704067200", "1704067200.5"),
    GOOD.replace('"userId":1', '"userId":99999999999'),
    GOOD.replace("userId", "USERID"),
    GOOD.replace("5.0", "null"),
    '{"movieId":10,"rating":5.0,"timestamp":1704067200}',
]
KEPT = [
    (GOOD.replace("5.0", "5"), 5.0),
    (GOOD.replace("5.0", "99.0"), 99.0),
    (GOOD.replace("}", ',"more":{"a":[1]}}'), 5.0),
    (GOOD + " and more", 5.0),
]


def _json(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "json string")


@pytest.mark.parametrize("text", DROPPED)
def test_dropped(spark, text):
    assert parse_ratings(_json(spark, [text])).count() == 0


@pytest.mark.parametrize("text,rating", KEPT)
def test_kept(spark, text, rating):
    row = parse_ratings(_json(spark, [text])).first()
    assert (row.userId, row.movieId, row.rating, row.event_time) == (1, 10, rating, 1704067200)


def test_quoted_nan_is_a_rating(spark):
    row = parse_ratings(_json(spark, [GOOD.replace("5.0", '"NaN"')])).first()
    assert math.isnan(row.rating)


def test_columns(spark):
    assert parse_ratings(_json(spark, [GOOD])).dtypes == [
        ("userId", "int"),
        ("movieId", "int"),
        ("rating", "double"),
        ("event_time", "bigint"),
        ("event_timestamp", "timestamp"),
    ]


def test_event_time_as_timestamp(spark):
    row = parse_ratings(_json(spark, [GOOD])).select(F.col("event_timestamp").cast("timestamp_ntz"))
    assert row.first()[0] == dt.datetime(2024, 1, 1)


def test_range_is_optional(spark):
    texts = [GOOD, GOOD.replace("5.0", "0.4"), GOOD.replace("5.0", '"NaN"')]
    assert parse_ratings(_json(spark, texts)).count() == 3
    assert parse_ratings(_json(spark, texts), bounds=("rating", 0.5, 5.0)).count() == 1


def test_range_bounds_are_inclusive(spark, records):
    df = spark.createDataFrame([(0.4,), (0.5,), (5.0,), (5.1,), (None,), (float("nan"),)], "r double")
    assert records(range_filter(df, "r")) == [(0.5,), (5.0,)]


def test_encode_then_parse_gives_the_rows_back(spark, records):
    rows = [(1, 10, 5.0, 1704067200), (2, 20, 0.5, 0), (3, -1, 2.25, -5)]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp long")
    messages = encode_events(df, "userId", df.columns)
    assert messages.dtypes == [("key", "string"), ("value", "string")]
    payload = messages.withColumn("value", F.col("value").cast("binary"))
    parsed = parse_ratings(decode_payload(payload))
    assert records(parsed, "userId", "movieId", "rating", "event_time") == rows


def test_records_are_parsed_once(spark):
    plan = parse_ratings(_json(spark, [GOOD]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
