import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.events import parse_ratings
from tidemark.operators.stats import key_avg, key_stats, windowed_stats

# Three records and their expected statistics.
RECORDS = [
    '{"userId":1,"movieId":10,"rating":5.0,"timestamp":1704067200}',
    '{"userId":2,"movieId":10,"rating":3.0,"timestamp":1704067210}',
    '{"userId":3,"movieId":20,"rating":4.0,"timestamp":1704067220}',
]
WINDOW = (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 1))
EXPECTED = [(*WINDOW, 10, 2, 4.0, 5.0, 3.0), (*WINDOW, 20, 1, 4.0, 4.0, 4.0)]
COLUMNS = [
    ("window_start", "timestamp"),
    ("window_end", "timestamp"),
    ("movieId", "int"),
    ("rating_count", "bigint"),
    ("avg_rating", "double"),
    ("max_rating", "double"),
    ("min_rating", "double"),
]


def without_zone(df):
    times = ("window_start", "window_end")
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def test_three_records(spark, records):
    stats = windowed_stats(parse_ratings(spark.createDataFrame([(r,) for r in RECORDS], "json string")))
    assert stats.dtypes == COLUMNS
    assert records(without_zone(stats)) == EXPECTED


def _events(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp_ntz, k string, v double")


def test_windows_are_half_open_and_aligned(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, s), "a", 1.0) for s in (0, 59)]
    rows.append((dt.datetime(2024, 1, 1, 0, 1), "a", 1.0))
    rows.append((dt.datetime(1969, 12, 31, 23, 59, 59), "a", 1.0))
    counts = {r.window_start: r.v_count for r in windowed_stats(_events(spark, rows), "ts", "k", "v").collect()}
    assert counts == {
        dt.datetime(2024, 1, 1): 2,
        dt.datetime(2024, 1, 1, 0, 1): 1,
        dt.datetime(1969, 12, 31, 23, 59): 1,
    }


def test_rows_without_time_are_left_out(spark):
    assert windowed_stats(_events(spark, [(None, "a", 1.0)]), "ts", "k", "v").count() == 0


def test_mean_is_rounded_half_up(spark):
    rows = [(dt.datetime(2024, 1, 1), "a", v) for v in (1.0, 1.01)]
    assert windowed_stats(_events(spark, rows), "ts", "k", "v").first().avg_v == 1.01  # 1.005


@pytest.mark.parametrize("scale", [None, 2])
def test_against_plain_python(spark, scale):
    random.seed(3)
    start = dt.datetime(2024, 3, 1)
    rows = [
        # One key holds a third of all rows.
        (start + dt.timedelta(seconds=random.randrange(900)), random.choice("aaabcdefg"), random.randrange(1, 500) / 100)
        for _ in range(3000)
    ]
    expected = {}
    for ts, k, v in rows:
        expected.setdefault((ts.replace(second=0), k), []).append(v)
    actual = windowed_stats(_events(spark, rows), "ts", "k", "v", scale=scale).collect()
    assert len(actual) == len(expected)
    for r in actual:
        values = expected[r.window_start, r.k]
        assert (r.v_count, r.max_v, r.min_v) == (len(values), max(values), min(values))
        assert r.avg_v == pytest.approx(sum(values) / len(values), abs=0.00501)
        assert r.window_end - r.window_start == dt.timedelta(minutes=1)


def test_per_key(spark, records):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 4.0), ("b", None)], "k string, v double")
    assert records(key_avg(df, "k", "v")) == [("a", 1.5), ("b", 4.0)]
    assert records(key_avg(df, "k", "v", scale=2)) == [("a", 1.5), ("b", 4.0)]
    assert records(key_stats(df, "k", "v")) == [("a", 2, 1.5, 2.0, 1.0), ("b", 2, 4.0, 4.0, 4.0)]


def test_rows_are_summed_up_before_the_shuffle(spark):
    df = _events(spark, [(dt.datetime(2024, 1, 1), "a", 1.0)])
    plan = windowed_stats(df, "ts", "k", "v")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") == 2 and "partial_count" in plan
