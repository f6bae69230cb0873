import datetime as dt
import math
import random
import statistics

import pytest

from tidemark.operators import analysis

START = dt.datetime(2023, 11, 28, 22)


@pytest.fixture(scope="module")
def ratings():
    """User 1 and movie 10 each have a third of all rows."""
    random.seed(13)
    return [
        (
            random.choice([1, 1, 2, 3]),
            random.choice([10, 10, 20, 30, 40]),
            random.choice([0.5, 3.0, 3.5, 5.0]),
            START + dt.timedelta(minutes=random.randrange(60 * 24 * 100)),
        )
        for _ in range(500)
    ]


@pytest.fixture(scope="module")
def df(spark, ratings):
    return spark.createDataFrame(ratings, "userId int, movieId int, rating double, ts timestamp_ntz")


def _group(rows, key):
    groups = {}
    for row in rows:
        groups.setdefault(key(row), []).append(row)
    return groups


def test_histogram(df, ratings):
    rows = analysis.value_histogram(df, "rating").collect()
    assert {r.rating: r.row_count for r in rows} == {
        v: len(g) for v, g in _group(ratings, lambda r: r[2]).items()
    }
    assert math.isclose(sum(r.share for r in rows), 1.0)


def test_top_keys_break_ties_by_key(spark):
    rows = [("b", 4.0), ("a", 4.0), ("c", 5.0), ("d", 4.5), ("d", 4.5)]
    df = spark.createDataFrame(rows, "k string, v double")
    assert [r.k for r in analysis.top_keys(df, "k", "v", k=3).collect()] == ["c", "d", "a"]
    assert [r.k for r in analysis.top_keys(df, "k", "v", k=3, min_count=2).collect()] == ["d"]


@pytest.mark.parametrize("scale", [None, 2])
def test_categories(spark, df, ratings, scale):
    genres = {10: "Drama|Comedy", 20: "Comedy", 30: "Drama|War|Drama", 50: "Musical", 60: None}
    movies = spark.createDataFrame(list(genres.items()), "movieId int, genres string")
    rows = analysis.category_stats(df, movies, "movieId", "rating", "genres", scale=scale).collect()
    expected = {}
    for r in ratings:
        for genre in set((genres.get(r[1]) or "").split("|")) - {""}:
            expected.setdefault(genre, []).append(r)
    assert {r.category for r in rows} == set(expected)
    for r in rows:
        facts = expected[r.category]
        assert (r.row_count, r.item_count) == (len(facts), len({f[1] for f in facts}))
        assert r.avg_value == pytest.approx(statistics.fmean(f[2] for f in facts))


def test_no_fact_is_repeated_for_its_categories(spark, df):
    movies = spark.createDataFrame([(10, "a|b")], "movieId int, genres string")
    plan = analysis.category_stats(df, movies, "movieId", "rating", "genres", scale=2)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    join = text[text.index("Join") :]
    assert "Aggregate [movieId" in join.split("explode")[0]


def test_months_and_hours(df, ratings):
    months = {r.month: r for r in analysis.stats_by_month(df, "ts", "rating", scale=2).collect()}
    expected = _group(ratings, lambda r: r[3].replace(day=1, hour=0, minute=0))
    assert {m: r.row_count for m, r in months.items()} == {m: len(g) for m, g in expected.items()}
    hours = {r.hour: r for r in analysis.stats_by_hour(df, "ts", "rating").collect()}
    for hour, rows in _group(ratings, lambda r: r[3].hour).items():
        assert hours[hour].row_count == len(rows)
        assert hours[hour].avg_value == pytest.approx(statistics.fmean(r[2] for r in rows))


def test_users(spark, df, ratings):
    nobody = (None, 10, None, dt.datetime(1969, 12, 31, 23))
    everyone = df.unionByName(spark.createDataFrame([nobody], df.schema))
    users = {
        r.userId: r
        for r in analysis.user_behaviour(everyone, "userId", "movieId", "rating", "ts").collect()
    }
    expected = _group(ratings, lambda r: r[0])
    assert set(users) == {*expected, None}
    for user, rows in expected.items():
        actual, values = users[user], [r[2] for r in rows]
        assert actual.row_count == len(rows)
        assert actual.item_count == len({r[1] for r in rows})
        assert actual.avg_value == pytest.approx(statistics.fmean(values))
        assert actual.stddev_value == pytest.approx(statistics.pstdev(values), abs=1e-6)
        assert actual.first_seen == min(r[3] for r in rows)
        assert actual.last_seen == max(r[3] for r in rows)
        assert actual.active_days == len({r[3].date() for r in rows})
    assert (users[None].row_count, users[None].avg_value, users[None].active_days) == (1, None, 1)


def test_active_days_without_times(spark, records):
    df = spark.createDataFrame([(1, None), (2, dt.date(1960, 2, 29))], "u int, d date")
    assert records(analysis.active_days(df, "u", "d")) == [(1, 0), (2, 1)]
