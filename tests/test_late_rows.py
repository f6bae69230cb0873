"""Late rows of a stream: counted, kept, taken in again."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from test_stats import without_zone
from tidemark.operators.stats import windowed_stats
from tidemark.streaming import late

START = dt.datetime(2024, 1, 1)
SCHEMA = "event_timestamp timestamp, movieId int, rating double"


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def feed(spark, path, batches, **options):
    writer = late.LateAwareWriter(str(path), scale=1, **options)
    for number, rows in enumerate(batches):
        writer(spark.createDataFrame(rows, SCHEMA), number)
    return late.read_parts(spark, str(path))


def kept(spark, path):
    rows = late.late_rows(spark, str(path))
    return sorted((r.batch_id, r.event_timestamp, r.movieId) for r in rows.collect()) if rows is not None else []


BATCHES = [
    [(at(0), 10, 4.0), (at(200), 20, 3.0)],
    [(at(30), 10, 2.0), (at(139), 10, 1.0), (at(90), 20, 5.0)],  # the watermark is at 140: minutes 0 and 1 have ended
    [],
    [(at(141), 10, 1.0), (None, 10, 5.0), (at(59), None, 2.0)],
]


def test_a_row_is_late_when_its_window_has_ended(spark, tmp_path, records):
    parts = feed(spark, tmp_path, BATCHES)
    assert kept(spark, tmp_path) == [(1, at(30), 10), (1, at(90), 20), (3, at(59), None)]
    counts = late.reconciled_stats(parts, scale=1).groupBy().sum("rating_count", "late_count").first()
    assert tuple(counts) == (7, 3)
    on_time = records(without_zone(late.on_time_stats(parts, scale=1)).select("window_start", "movieId", "rating_count", "avg_rating"))
    assert on_time == [(at(0), 10, 1, 4.0), (at(120), 10, 2, 1.0), (at(180), 20, 1, 3.0)]


def test_reconciled_equals_the_batch_result_in_any_order(spark, tmp_path, records):
    rng = random.Random(1)
    rows = [(at(rng.randint(0, 3600)), rng.choice([1, 1, 1, 2, 3]), rng.choice([None, 0.5, 1.5, 4.0])) for _ in range(2000)]
    batches = [rows[k::6] for k in range(6)]
    got = late.reconciled_stats(feed(spark, tmp_path, batches), scale=1)
    want = windowed_stats(spark.createDataFrame(rows, SCHEMA), scale=1)
    assert records(without_zone(got.drop("late_count"))) == records(without_zone(want))
    # By the definition, batch by batch.
    expected, seen = 0, None
    for batch in batches:
        if seen is not None:
            expected += sum(t.replace(second=0) + dt.timedelta(minutes=1) <= seen - dt.timedelta(minutes=1) for t, _, _ in batch)
        seen = max([t for t, _, _ in batch] + [seen or START])
    assert got.agg(F.sum("late_count")).first()[0] == expected == len(kept(spark, tmp_path)) > 1000


def test_a_batch_run_again_leaves_one_copy(spark, tmp_path, records):
    parts = feed(spark, tmp_path, BATCHES)
    before, rows = records(parts), kept(spark, tmp_path)
    again = late.LateAwareWriter(str(tmp_path), scale=1)
    again(spark.createDataFrame(BATCHES[1], SCHEMA), 1)
    again(spark.createDataFrame(BATCHES[3], SCHEMA), 3)
    assert records(late.read_parts(spark, str(tmp_path))) == before and kept(spark, tmp_path) == rows


def test_a_crash_before_the_progress_is_made_good(spark, tmp_path, records, monkeypatch):
    writer = late.LateAwareWriter(str(tmp_path / "a"), scale=1)
    writer(spark.createDataFrame(BATCHES[0], SCHEMA), 0)
    with monkeypatch.context() as broken:
        broken.setattr(late, "_leave", lambda *_: (_ for _ in ()).throw(OSError("executor lost")))
        with pytest.raises(OSError):
            writer(spark.createDataFrame(BATCHES[1], SCHEMA), 1)
    for number in (1, 2, 3):
        writer(spark.createDataFrame(BATCHES[number], SCHEMA), number)
    parts = feed(spark, tmp_path / "b", BATCHES)
    assert records(late.read_parts(spark, str(tmp_path / "a"))) == records(parts)


def test_progress_files_stay_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(late, "KEPT", 2)
    feed(spark, tmp_path, BATCHES)
    assert len(list((tmp_path / "_progress").glob("*.json"))) == 2
    assert late.seen_before(spark, str(tmp_path), 99) == late.seen_before(spark, str(tmp_path), 3)


def test_only_empty_batches(spark, tmp_path):
    parts = feed(spark, tmp_path, [[], []])
    assert late.reconciled_stats(parts, scale=1).count() == 0 and late.late_rows(spark, str(tmp_path)) is None
