"""Index of files, ledger of processed files, and tables of keyed files."""

import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import file_index
from tidemark.operators.file_index import files_that_may_hold, index_files
from tidemark.operators.incremental import apply_changes
from tidemark.operators.ledger import Ledger
from tidemark.sinks.keyed import KeyedTable
from tidemark.snapshots import SharedFiles, SnapshotConflict

SCHEMA = "id bigint, part string, v bigint, version int"
KEYS = ["id", "part"]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def test_index_rules_files_out_but_never_wrongly(spark, monkeypatch):
    rows = [(f"f{k % 5}", k, None if k % 11 == 0 else f"p{k % 3}") for k in range(4000)] + [("one", None, None), ("big", 10**9, "p")]
    index = index_files(frame(spark, rows, "file string, id bigint, part string"), KEYS).cache()
    rng = random.Random(1)
    for _ in range(6):
        asked = [(k, p) for _, k, p in rng.sample(rows, 2)] + [(rng.randrange(10**6), "p0")]
        found = files_that_may_hold(index, frame(spark, asked, "id bigint, part string"), KEYS)
        assert {f for f, k, p in rows if (k, p) in asked} <= set(found)
    # 300 absent keys within the range of every file: the filters rule most out; beyond the bound ranges decide.
    absent = frame(spark, [(k, "none") for k in range(0, 4000, 800)], "id bigint, part string")
    assert len(files_that_may_hold(index, absent, KEYS)) <= 2
    monkeypatch.setattr(file_index, "MAX_PROBED_KEYS", 2)
    assert files_that_may_hold(index, absent, KEYS) == [f"f{k}" for k in range(5)]
    assert files_that_may_hold(index, absent.limit(0), KEYS) == []


@pytest.fixture
def landing(spark, tmp_path):
    schema = frame(spark, []).schema

    def deliver(rows, files=2):
        frame(spark, rows).repartition(files).write.mode("append").parquet(str(tmp_path / "in"))

    return deliver, lambda: Ledger(spark, str(tmp_path / "ledger"), str(tmp_path / "in"), schema, KEYS)


def picked(increment):
    return sorted((tuple(r) for r in increment.rows.collect()), key=repr)


def test_each_key_is_picked_up_once(landing):
    deliver, ledger = landing
    assert ledger().pending() is None
    first = [(k, "a", k, 1) for k in range(100)] + [(None, None, 1, 1)]
    deliver(first)
    increment = ledger().pending()
    assert picked(increment) == sorted(first, key=repr) and increment.number == 1
    assert picked(ledger().pending()) == picked(increment)  # not committed: given again
    increment.commit()
    assert ledger().pending() is None
    # Late keys, replays with other values, a replayed null key, twice the same new key.
    deliver([(-5, "a", 1, 1), (7, "a", 70, 9), (None, None, 1, 2), (7, "b", 1, 1), (300, "a", 2, 1), (300, "a", 1, 1)])
    increment = ledger().pending()
    assert picked(increment) == sorted([(-5, "a", 1, 1), (7, "b", 1, 1), (300, "a", 1, 1)], key=repr)
    increment.commit()
    deliver([(-5, "a", 4, 4)])
    increment = ledger().pending()
    assert picked(increment) == []
    increment.commit()
    assert ledger().pending() is None


def test_of_two_readers_one_commits(landing):
    deliver, ledger = landing
    deliver([(1, "a", 1, 1)])
    one, two = ledger().pending(), ledger().pending()
    one.commit()
    with pytest.raises(SnapshotConflict):
        two.commit()


def test_a_changed_or_deleted_file_is_an_error(landing, tmp_path):
    deliver, ledger = landing
    deliver([(k, "a", k, 1) for k in range(50)], 1)
    ledger().pending().commit()
    old = next((tmp_path / "in").glob("*.parquet"))
    data = old.read_bytes()
    old.unlink()
    deliver([(3, "a", 1, 1)], 1)
    with pytest.raises(FileNotFoundError):
        ledger().pending()
    old.write_bytes(data[:-1] + b"x")
    with pytest.raises(ValueError, match="changed"):
        ledger().pending()


def digests(table):
    return {f: hashlib.sha256(Path(table.path, f).read_bytes()).hexdigest() for f in table.files()}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def keyed(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "table"), frame(spark, []).schema, KEYS, "version", file_rows=100)
    base = [(k, f"p{k % 2}", k, 5) for k in range(1000)] + [(None, None, 0, 5)]
    table.create(frame(spark, base))
    return table, base


def test_only_touched_files_are_rewritten(spark, keyed):
    table, base = keyed
    before = digests(table)
    assert len(before) == 11
    changes = [(3, "p1", 30, 6, "U"), (3, "p1", 31, 7, "U"), (4, "p0", 0, 6, "D"), (5, "p1", 99, 1, "U"), (6, "zz", 1, 1, "U"), (None, None, 8, 9, "U"), (5000, "n", 1, 1, "D")]
    frame_of = frame(spark, changes, SCHEMA + ", op string")
    want = rows_of(apply_changes(frame(spark, base), frame_of, KEYS, "version"))
    reader = table.read()
    table.apply(frame_of, op="op")
    after = digests(table)
    # Those with the keys 3 to 5 and null hold changed keys; the key 6, zz is new and has no file.
    kept = before.keys() & after.keys()
    assert 8 <= len(kept) <= 10 and all(before[f] == after[f] for f in kept)
    assert rows_of(table.read()) == want
    table.expire(keep_seconds=3600)
    assert rows_of(reader) == sorted(base, key=repr)
    table.expire(keep_seconds=0)
    assert rows_of(table.read()) == want and digests(table) == after
    data = Path(table.path, "_data")
    assert sum(len(list(p.glob("*.parquet"))) for p in data.iterdir()) == len(after)


def test_upserts_without_operations(spark, keyed):
    table, base = keyed
    table.apply(frame(spark, [(2000, "n", 1, 1), (1, "p1", 11, 6)]))
    assert rows_of(table.read().where("id in (1, 2000)")) == [(1, "p1", 11, 6), (2000, "n", 1, 1)]
    assert table.read().count() == len(base) + 1
    assert table.apply(frame(spark, [])) == 3 and table.read().count() == len(base) + 1


def test_a_crash_and_a_conflict_change_nothing(spark, keyed, monkeypatch):
    table, base = keyed
    files = table.files()

    def killed(self, *args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(SharedFiles, "put_new", killed)
        with pytest.raises(KeyboardInterrupt):
            table.apply(frame(spark, [(1, "p1", 11, 6)]))
    assert table.files() == files and rows_of(table.read()) == sorted(base, key=repr)
    with pytest.raises(SnapshotConflict):
        table.create(frame(spark, base))
    table.apply(frame(spark, [(1, "p1", 11, 6)]))
    assert table.read().where("id = 1").first().v == 11


def test_a_table_without_rows(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), frame(spark, []).schema, KEYS, "version")
    table.create(frame(spark, []))
    assert table.read().count() == 0
    table.apply(frame(spark, [(1, "a", 1, 1)]))
    changes = frame(spark, [(1, "a", 1, 2)]).withColumn("op", F.lit("D"))
    assert table.read().count() == 1
    table.apply(changes, op="op")
    assert table.read().count() == 0 and table.files() == []
