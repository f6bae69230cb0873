import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from test_stats import COLUMNS, EXPECTED, RECORDS, without_zone
from tidemark.operators.events import parse_ratings
from tidemark.operators.incremental import latest_version
from tidemark.operators.stats import windowed_stats
from tidemark.sinks import BatchWriter, append_parquet, read_batches
from tidemark.sinks.batches import first_batch
from tidemark.sources import read_result_table, stream_files
from tidemark.streaming.job import (
    DRAIN,
    finish,
    rating_stats,
    start_batches,
    start_landing,
    start_memory,
)

T = 1704067200
KEYS = ["window_start", "window_end", "movieId"]


def record(movie, time, rating=4.0):
    return json.dumps({"userId": 1, "movieId": movie, "rating": rating, "timestamp": time})


class Inbox:
    """A directory that receives files of records, one after the other."""

    def __init__(self, path):
        self.path, self.files = path, 0
        path.mkdir()

    def add(self, *records):
        lines = "".join(json.dumps({"json": r}) + "\n" for r in records)
        self.files += 1
        hidden = self.path / f"_{self.files}.json"
        hidden.write_text(lines, encoding="utf-8")
        os.utime(hidden, (T + self.files, T + self.files))  # the stream goes by file time
        hidden.rename(self.path / f"{self.files}.json")

    def stream(self, spark, **options):
        return stream_files(spark, str(self.path), "json", "json string", **options)


@pytest.fixture
def inbox(tmp_path):
    return Inbox(tmp_path / "inbox")


def test_drained_into_memory(spark, inbox, tmp_path, records):
    inbox.add(*RECORDS)
    stats = rating_stats(inbox.stream(spark))
    finish(start_memory(stats, "three_records", str(tmp_path / "checkpoint")), timeout=60)
    result = read_result_table(spark, "three_records")
    assert result.dtypes == COLUMNS
    assert records(without_zone(result)) == EXPECTED


def _drain(stats, writer, tmp_path):
    finish(start_batches(stats, writer, str(tmp_path / "checkpoint"), DRAIN), timeout=120)


def _latest(spark, path, stats):
    return without_zone(latest_version(read_batches(spark, path, stats.schema), KEYS, "batch_id"))


def test_batches_and_restarts_equal_one_batch(spark, inbox, tmp_path, records):
    out, everything = str(tmp_path / "out"), []
    stats = rating_stats(inbox.stream(spark))
    for n in range(3):
        some = [record(m, T + 40 * n + s, 0.5 + (m + s) % 5) for m in (10, 20) for s in range(30)]
        everything += some
        inbox.add(*some)
        _drain(stats, BatchWriter(out), tmp_path)
    batch = windowed_stats(parse_ratings(spark.createDataFrame([(r,) for r in everything], "json string")))
    # A minute that two batches touched has two versions on disk.
    assert read_batches(spark, out, stats.schema).count() > batch.count()
    assert records(_latest(spark, out, stats).drop("batch_id")) == records(without_zone(batch))
    # Counts grow from version to version, so they can serve as one.
    by_count = latest_version(read_batches(spark, out, stats.schema), KEYS, "rating_count")
    assert records(without_zone(by_count.drop("batch_id"))) == records(without_zone(batch))


LATE = [
    [record(10, T)],
    [record(20, T + 200)],
    [record(10, T + 30), record(20, T + 201)],
    [record(10, T + 31), record(20, T + 202)],
    [record(20, T + 203)],
]


def _dropped(query):
    operators = (op for p in query.recentProgress for op in p["stateOperators"])
    return sum(op["numRowsDroppedByWatermark"] for op in operators)


def test_late_rows_are_judged_by_the_watermark_of_the_batch_before(spark, inbox, tmp_path):
    for batch in LATE:
        inbox.add(*batch)
    out = str(tmp_path / "out")
    stats = rating_stats(inbox.stream(spark, max_files_per_trigger=1))
    query = start_batches(stats, BatchWriter(out), str(tmp_path / "checkpoint"), DRAIN)
    finish(query, timeout=120)
    first_minute = _latest(spark, out, stats).filter(F.col("movieId") == 10).collect()
    assert [r.rating_count for r in first_minute] == [2]
    assert _dropped(query) == 1


def test_late_rows_are_dropped_after_a_restart_too(spark, inbox, tmp_path):
    out, dropped = str(tmp_path / "out"), []
    stats = rating_stats(inbox.stream(spark))
    for batch in LATE:
        inbox.add(*batch)
        query = start_batches(stats, BatchWriter(out), str(tmp_path / "checkpoint"), DRAIN)
        finish(query, timeout=120)
        dropped.append(_dropped(query))
    (first_minute,) = _latest(spark, out, stats).filter(F.col("movieId") == 10).collect()
    assert dropped[:2] == [0, 0] and dropped[3] == 1
    assert first_minute.rating_count + sum(dropped) == 3  # every row is counted or dropped


def test_a_retried_batch_leaves_one_copy(spark, tmp_path, records):
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    exported = []
    writer = BatchWriter(str(tmp_path / "out"), export=lambda df: exported.append(records(df)))
    writer(batch, 0)
    writer(batch, 1)
    writer(batch, 1)
    rows = records(read_batches(spark, str(tmp_path / "out"), batch.schema))
    assert rows == [(1, "a", 0), (1, "a", 1), (2, "b", 0), (2, "b", 1)]
    assert exported == [[(1, "a"), (2, "b")]] * 3  # at least once


def test_an_empty_batch_adds_nothing(spark, tmp_path, records):
    batch = spark.createDataFrame([(1, "a")], "id long, v string")
    writer = BatchWriter(str(tmp_path / "out"), files_per_batch=1)
    writer(batch, 0)
    writer(batch.limit(0), 1)
    assert records(read_batches(spark, str(tmp_path / "out"), batch.schema)) == [(1, "a", 0)]


def test_an_empty_batch_leaves_no_folder(spark, tmp_path):
    exported = []
    writer = BatchWriter(str(tmp_path / "out"), export=exported.append)
    writer(spark.createDataFrame([], "id long"), 7)
    assert not exported and not list((tmp_path / "out").glob("batch_id=*"))


def test_a_new_checkpoint_adds_to_the_output(spark, inbox, tmp_path, records):
    """Numbers go on from run to run, and a run keeps its own over restarts."""
    out, numbers = str(tmp_path / "out"), []
    stats = rating_stats(inbox.stream(spark))
    inbox.add(record(10, T))
    for run, more in (("a", record(20, T)), ("b", record(30, T)), ("a", record(10, T + 1))):
        inbox.add(more)
        _drain(stats, BatchWriter(out, exported_to(numbers), export_batch_id=True), tmp_path / run)
    assert first_batch(spark, str(tmp_path / "a" / "checkpoint")) == min(numbers)
    rows = read_batches(spark, out, stats.schema)
    assert rows.select("batch_id").distinct().count() == 3
    assert {r.movieId for r in _latest(spark, out, stats).collect()} == {10, 20, 30}


def exported_to(numbers):
    return lambda df: numbers.extend(r.batch_id for r in df.select("batch_id").distinct().collect())


def test_export_follows_the_files_and_sees_the_same_rows(spark, inbox, tmp_path, records):
    inbox.add(*RECORDS)
    out, exported = str(tmp_path / "out"), []
    stats = rating_stats(inbox.stream(spark))
    _drain(stats, BatchWriter(out, export=lambda df: exported.append(records(df))), tmp_path)
    assert sum(map(len, exported)) == 2
    assert sorted(exported[0]) == records(read_batches(spark, out, stats.schema).drop("batch_id"))


def test_landing_keeps_each_row_once(spark, inbox, tmp_path, records):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    parsed = parse_ratings(inbox.stream(spark))
    inbox.add(*RECORDS[:2], "not json")
    finish(start_landing(parsed, out, checkpoint, DRAIN), timeout=60)
    finish(start_landing(parsed, out, checkpoint, DRAIN), timeout=60)
    inbox.add(RECORDS[2])
    finish(start_landing(parsed, out, checkpoint, DRAIN), timeout=60)
    rows = records(spark.read.parquet(out), "userId", "movieId", "rating", "event_time")
    assert rows == [(1, 10, 5.0, T), (2, 10, 3.0, T + 10), (3, 20, 4.0, T + 20)]


def test_open_windows_wait_in_append_mode(spark, inbox, tmp_path):
    inbox.add(record(10, T), record(10, T + 300))
    out = str(tmp_path / "out")
    stats = rating_stats(inbox.stream(spark))
    query = start_batches(stats, BatchWriter(out), str(tmp_path / "checkpoint"), DRAIN, "append")
    finish(query, timeout=60)
    starts = [r.window_start for r in without_zone(read_batches(spark, out, stats.schema)).collect()]
    assert starts == [dt.datetime(2024, 1, 1)]


def test_a_query_that_does_not_end_is_stopped(spark, inbox, tmp_path):
    inbox.add(*RECORDS)
    writer = BatchWriter(str(tmp_path / "out"))
    query = start_batches(rating_stats(inbox.stream(spark)), writer, str(tmp_path / "checkpoint"))
    with pytest.raises(TimeoutError):
        finish(query, timeout=1)
    assert not query.isActive


def test_state_survives_a_killed_batch(spark, inbox, tmp_path, records):
    """A batch that failed between its sinks runs again after the restart, without duplicates."""
    inbox.add(*RECORDS)
    out = str(tmp_path / "out")
    stats = rating_stats(inbox.stream(spark))

    def broken(df):
        raise RuntimeError("database is away")

    with pytest.raises(Exception, match="database is away"):
        _drain(stats, BatchWriter(out, export=broken), tmp_path)
    exported = []
    _drain(stats, BatchWriter(out, export=lambda df: exported.extend(records(df))), tmp_path)
    assert len(exported) == 2
    assert records(_latest(spark, out, stats).drop("batch_id")) == EXPECTED
    assert read_batches(spark, out, stats.schema).count() == 2


def test_reading_plain_appended_results(spark, tmp_path, records):
    """Output without batch numbers: the growing count tells the versions apart."""
    schema = "window_start timestamp, window_end timestamp, movieId int, rating_count long, avg_rating double"
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 1)
    for count, mean in ((1, 5.0), (3, 4.0), (2, 4.5)):
        append_parquet(spark.createDataFrame([(start, end, 10, count, mean)], schema), str(tmp_path))
    latest = latest_version(spark.read.parquet(str(tmp_path)), KEYS, "rating_count")
    assert records(latest, "movieId", "rating_count", "avg_rating") == [(10, 3, 4.0)]
