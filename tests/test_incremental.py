import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import incremental


@pytest.fixture(scope="module")
def history():
    """Versions of rows; one key has a third of them."""
    random.seed(5)
    rows = [
        (random.choice([0, 0, 0, *range(1, 7)]), version, random.choice(["x", None, "z"]), random.random())
        for version in range(600)
    ]
    random.shuffle(rows)
    return rows


SCHEMA = "k int, version int, s string, v double"


def _newest(rows):
    best = {}
    for row in rows:
        if row[0] not in best or row[1] > best[row[0]][1]:
            best[row[0]] = row
    return best


def test_latest_version_takes_whole_rows(spark, history, records):
    df = spark.createDataFrame(history, SCHEMA).repartition(5)
    latest = incremental.latest_version(df, ["k"], "version")
    assert latest.columns == df.columns
    assert records(latest) == sorted(_newest(history).values(), key=repr)


def test_latest_version_of_numbers(spark, history, records):
    rows = [(k, version, v) for k, version, _, v in history]
    df = spark.createDataFrame(rows, "k int, version int, v double").repartition(5)
    latest = incremental.latest_version(df, ["k"], "version")
    assert records(latest) == sorted(_newest(rows).values(), key=repr)


def test_latest_version_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a")], SCHEMA.rsplit(",", 1)[0])
    latest = incremental.latest_version(df, ["k"], "version")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_latest_version_of_numbers_needs_no_sort(spark):
    df = spark.createDataFrame([(1, 1, 2.0)], "k int, version int, v double")
    plan = incremental.latest_version(df, ["k"], "version")._jdf.queryExecution().sparkPlan()
    assert "SortAggregate" not in plan.toString() and "Window" not in plan.toString()


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_increment_is_what_is_newer(spark, records, kind):
    times = [dt.datetime(2024, 1, d) for d in (1, 2, 3, 4)]
    df = spark.createDataFrame([(t, t.day) for t in times], f"ts {kind}, d int")
    done = df.filter("d <= 2")
    newer = incremental.incremental_delta(df, "ts", incremental.high_water(done, "ts"))
    assert records(newer, "d") == [(3,), (4,)]
    none_yet = incremental.high_water(df.filter("d > 9"), "ts")
    assert incremental.incremental_delta(df, "ts", none_yet).count() == 4
    assert incremental.incremental_delta(df, "ts", F.lit(times[2]).cast(kind)).count() == 1


def test_upsert(spark, history, records):
    base = spark.createDataFrame([(k, -1, "base", 0.0) for k in range(5, 12)], SCHEMA)
    delta = spark.createDataFrame(history, SCHEMA)
    merged = incremental.merge_upsert(base, delta, ["k"], "version")
    expected = {k: (k, -1, "base", 0.0) for k in range(5, 12)} | _newest(history)
    assert records(merged) == sorted(expected.values(), key=repr)


def test_upsert_with_nothing_new(spark, history, records):
    base = spark.createDataFrame(list(_newest(history).values()), SCHEMA)
    assert records(incremental.merge_upsert(base, base.limit(0), ["k"], "version")) == records(base)


def test_changes(spark, records):
    base = spark.createDataFrame([(k, f"old{k}") for k in range(1, 6)], "k int, s string")
    changes = [
        (1, "new1", 1, "U"),
        (2, None, 1, "D"),
        (3, None, 1, "D"),
        (3, "back3", 2, "U"),
        (4, "new4", 1, "U"),
        (4, None, 2, "D"),
        (7, "new7", 1, "U"),
        (8, None, 1, "D"),
    ]
    df = spark.createDataFrame(changes, "k int, s string, version int, op string")
    after = incremental.apply_changes(base, df, ["k"], "version")
    assert records(after) == [(1, "new1"), (3, "back3"), (5, "old5"), (7, "new7")]


@pytest.mark.parametrize("versions", [False, True])
def test_only_a_delta_of_small_measured_size_is_broadcast(spark, records, monkeypatch, versions):
    base = spark.range(1000).select((F.col("id") % 900).alias("k"), F.lit("old").alias("s"))
    base = base.withColumn("version", F.lit(2)) if versions else base
    changes = spark.range(500, 2000).select(F.col("id").alias("k"), F.lit("new").alias("s"), F.lit(3).alias("version"), F.when(F.col("id") % 2 == 0, "D").alias("op"))

    def joins():
        after = incremental.apply_changes(base, changes, ["k"], "version")
        rows = records(after.select("k", "s"))
        return rows, set(re.findall("SortMergeJoin|BroadcastHashJoin", after._jdf.queryExecution().executedPlan().toString()))

    small, plan = joins()
    assert "BroadcastHashJoin" in plan
    measured = incremental.broadcast_if_small
    monkeypatch.setattr(incremental, "broadcast_if_small", lambda df, label: measured(df, label, max_bytes=1000))
    large, plan = joins()
    assert "SortMergeJoin" in plan and large == small
    assert versions or "BroadcastHashJoin" not in plan
    assert large == sorted([*[(k % 900, "old") for k in range(1000) if k % 900 < 500], *[(k, "new") for k in range(501, 2000, 2)]], key=repr)


def test_merged_stats_equal_stats_of_all_rows(spark, records):
    random.seed(7)
    rows = [(random.choice("aaab"), random.randrange(100)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, v long")
    parts = [
        incremental.partial_stats(spark.createDataFrame(part, df.schema), ["k"], "v")
        for part in (rows[:123], rows[123:])
    ]
    merged = incremental.merge_stats(*parts, ["k"])
    assert records(merged) == records(incremental.partial_stats(df, ["k"], "v"))


def test_a_late_delta_undoes_nothing(spark, records):
    schema = "k int, version int, v string"
    base = spark.createDataFrame([(1, 5, "new"), (2, 1, "old"), (None, 1, "null"), (4, None, "x")], schema)
    delta = spark.createDataFrame([(1, 3, "late"), (2, 2, "newer"), (None, 2, "null2"), (4, 1, "y"), (5, None, "z")], schema)
    expected = sorted([(1, 5, "new"), (2, 2, "newer"), (None, 2, "null2"), (4, 1, "y"), (5, None, "z")], key=repr)
    assert records(incremental.merge_upsert(base, delta, ["k"], "version")) == expected
    assert records(incremental.merge_upsert(incremental.merge_upsert(base, delta, ["k"], "version"), delta, ["k"], "version")) == expected


def test_late_and_null_changes(spark, records):
    base = spark.createDataFrame([(1, 5, "a"), (None, 1, "b"), (3, 1, "c")], "k int, version int, v string")
    changes = spark.createDataFrame(
        [(1, 4, None, "D"), (None, 2, None, "D"), (3, 2, "d", "U"), (6, 1, "e", None)], "k int, version int, v string, op string"
    )
    assert records(incremental.apply_changes(base, changes, ["k"], "version")) == sorted([(1, 5, "a"), (3, 2, "d"), (6, 1, "e")], key=repr)


@pytest.mark.parametrize("kind", ["string", "double"])
def test_null_versions_in_either_form(spark, records, kind):
    rows = [(1, None, "7"), (2, None, "8"), (2, 3, None)]
    df = spark.createDataFrame(rows, "k int, version int, v string").withColumn("v", F.col("v").cast(kind))
    latest = incremental.latest_version(df, ["k"], "version").withColumn("v", F.col("v").cast("int"))
    assert records(latest) == [(1, None, 7), (2, 3, None)]
