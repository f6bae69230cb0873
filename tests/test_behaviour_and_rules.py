"""Mergeable parts of user behaviour, and rules across rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import analysis, behaviour
from tidemark.operators.cross_rules import Refers, Unique, check_rows
from tidemark.operators.validate import REASON

SCHEMA = "u string, i string, v double, ts timestamp_ntz"


def events(n, seed=1):
    rng = random.Random(seed)
    begin = dt.datetime(2024, 1, 1)
    return [
        (rng.choice(["hot", "hot", None, f"u{rng.randrange(20)}"]), rng.choice([None, f"i{rng.randrange(200)}"]), rng.choice([None, rng.randrange(-500, 500) / 100]), begin + dt.timedelta(hours=rng.randrange(9000)))
        for _ in range(n)
    ]


def test_merged_parts_equal_a_recount(spark, tmp_path, records):
    rows = events(900) + [("empty", None, None, dt.datetime(2024, 1, 1))]
    numbers = kept = None
    for step, some in enumerate((rows[:200], [], rows[200:201], rows[201:])):
        part = spark.createDataFrame(some, SCHEMA)
        numbers = behaviour.item_numbers(part, "i", numbers)
        parts = behaviour.user_parts(part, "u", "i", "v", "ts", 2, numbers)
        parts = parts if kept is None else kept.merged(parts)
        parts.write(str(tmp_path / str(step)))
        kept = behaviour.read_parts(spark.read, str(tmp_path / str(step)), "u", 2)
    items = {r[1] for r in rows if r[1]}
    found = {r.i: r.number for r in numbers.collect()}
    assert found.keys() == items and sorted(found.values()) == list(range(len(items)))
    whole = analysis.user_behaviour(spark.createDataFrame(rows, SCHEMA), "u", "i", "v", "ts", scale=2)
    columns = ["u", "row_count", "avg_value", "first_seen", "last_seen", "item_count", "active_days"]
    assert records(kept.behaviour(), *columns) == records(whole, *columns)
    spread = {r.u: r.stddev_value for r in whole.collect()}
    assert all(r.stddev_value == pytest.approx(spread[r.u], abs=2e-6) for r in kept.behaviour().collect())


def test_numbers_stay_when_items_are_added(spark):
    first = behaviour.item_numbers(spark.range(100).selectExpr("cast(id as string) as i"), "i")
    more = behaviour.item_numbers(spark.range(50, 180).selectExpr("cast(id as string) as i"), "i", first)
    before, after = ({r.i: r.number for r in df.collect()} for df in (first, more))
    assert before.items() <= after.items() and sorted(after.values()) == list(range(180))


def brute(rows, parents, with_order):
    found = []
    for k, row in enumerate(rows):
        same = [r for r in rows if r[0] == row[0]]
        reason = None
        if row[1] is not None and row[1] not in parents:
            reason = "parent"
        elif row[0] is not None and len(same) > 1 and not (with_order and row[2] == min(r[2] for r in same)):
            reason = "twice"
        elif not row[2] < 90:
            reason = "range"
        found.append((*row, reason))
    return sorted(found, key=repr)


@pytest.mark.parametrize("with_order", [False, True])
def test_rules_across_rows(spark, records, with_order, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, *range(2, 400)]) if k % 3 else 1, rng.choice([None, *range(30)]), k % 100) for k in range(300)]
    parents = set(range(0, 30, 2))
    df = spark.createDataFrame(rows, "key int, parent int, v int").repartition(5)
    other = spark.createDataFrame([(p,) for p in [*parents, 2, None]], "id int")
    rules = [("parent", Refers(("parent",), other, ("id",))), ("twice", Unique(("key",), ("v",) if with_order else ())), ("range", F.col("v") < 90)]
    want = brute(rows, parents, with_order)
    assert records(check_rows(df, rules)) == want
    # The same where the broken keys are too many to broadcast.
    from tidemark.operators import cross_rules

    monkeypatch.setattr(cross_rules, "broadcast_if_small", lambda keys, label: keys)
    checked = check_rows(df, rules)
    assert records(checked) == want and checked.columns == ["key", "parent", "v", REASON]


def test_a_hot_key(spark):
    df = spark.range(30_000, numPartitions=4).select(F.greatest(F.col("id"), F.lit(9_999)).alias("key"), "id")
    checked = check_rows(df, [("twice", Unique(("key",)))])
    assert checked.where(F.col(REASON) == "twice").count() == 10_000
    assert "BroadcastHashJoin" in checked._jdf.queryExecution().executedPlan().toString()


def test_no_rows(spark):
    df = spark.createDataFrame([], "key int, parent int")
    assert check_rows(df, [("a", Unique(("key",))), ("b", Refers(("parent",), df, ("key",)))]).count() == 0
