import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from tidemark.operators.clean import clean_ratings
from tidemark.operators.events import encode_events
from tidemark.plans.tables import table
from tidemark.sinks import (
    ensure_database,
    jdbc_properties,
    preview,
    publish_table,
    register_files,
    register_folder,
    write_csv,
    write_jdbc,
    write_kafka,
    write_parquet,
)
from tidemark.sinks.catalog import expire_published, missing_tables
from tidemark.sources import kafka_stream, read_csv_text, read_result_table, read_table
from tidemark.streaming import job
from tidemark.streaming.config import StreamConfig

SCHEMA = "id long, name string, v double, ts timestamp_ntz"
ROWS = [
    (1, 'with "quotes", and comma', 1.5, dt.datetime(2024, 1, 1, 12)),
    (2, "é語", None, dt.datetime(2024, 1, 2)),
]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_one_reader_for_all_formats(spark, df, tmp_path, fmt, records):
    path = str(tmp_path / fmt)
    df.write.format(fmt).option("header", True).option("escape", '"').save(path)
    assert records(read_table(spark, path, fmt, df.schema)) == ROWS


def test_reader_arguments(spark):
    with pytest.raises(ValueError, match="csv, json, parquet"):
        read_table(spark, "x", "xml")
    with pytest.raises(ValueError, match="schema"):
        read_table(spark, "x", "csv")


@pytest.mark.parametrize("read", [
    lambda s, p: read_table(s, p, "parquet"),
    lambda s, p: read_csv_text(s, p),
])
def test_missing_input_is_an_error_at_once(spark, tmp_path, read):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read(spark, str(tmp_path / "nowhere"))


def test_csv_has_headers_and_is_replaced(spark, df, tmp_path, records):
    path = tmp_path / "out"
    write_csv(df, str(path))
    write_csv(df, str(path))
    parts = [p for p in path.iterdir() if p.suffix == ".csv"]
    assert all(p.read_text().startswith("id,name,v,ts\n") for p in parts)
    assert records(read_table(spark, str(path), "csv", df.schema)) == ROWS


def test_parquet_is_replaced(spark, df, tmp_path):
    for _ in range(2):
        write_parquet(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(ROWS)


def test_preview(df, capsys):
    preview(df.select("id"))
    assert "| id|" in capsys.readouterr().out


def test_jdbc_settings(df, monkeypatch):
    calls = []

    def jdbc(self, url, table, mode=None, properties=None):
        calls.append((url, table, properties))

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    properties = jdbc_properties("me", "secret", connections=4)
    write_jdbc(df, "stats", "jdbc:mysql://db/x", properties)
    assert calls == [("jdbc:mysql://db/x", "stats", properties)]
    assert properties["driver"] == "com.mysql.cj.jdbc.Driver"
    assert (properties["user"], properties["password"]) == ("me", "secret")
    assert properties["numPartitions"] == "4"


def test_jdbc_mode(df, monkeypatch):
    modes = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda *a, **k: None)
    mode = DataFrameWriter.mode
    monkeypatch.setattr(DataFrameWriter, "mode", lambda w, m: modes.append(m) or mode(w, m))
    write_jdbc(df, "t", "jdbc:x", {})
    write_jdbc(df, "t", "jdbc:x", {}, mode="overwrite")
    assert modes == ["append", "overwrite"]


def test_kafka_needs_its_connector(spark, df):
    """Without the connector both ends name the missing source; with it nothing here runs."""
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
    except Exception:
        with pytest.raises(Exception, match="(?i)kafka"):
            kafka_stream(spark, "localhost:9092", "ratings", max_offsets_per_trigger=10)
        with pytest.raises(Exception, match="(?i)kafka"):
            write_kafka(encode_events(df, "id", ["id"]), "localhost:9092", "ratings")


@pytest.mark.parametrize("enabled", [True, False])
def test_the_whole_job_is_wired_from_its_settings(spark, tmp_path, monkeypatch, records, enabled):
    """The job with a file stream in place of the broker and a list in place of the database."""
    inbox = tmp_path / "inbox"
    rows = [(1, 10, 5.0, 1704067200), (2, 10, 3.0, 1704067210)]
    ratings = spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp long")
    encode_events(ratings, "userId", ratings.columns).write.parquet(str(inbox))
    asked, exported = [], []

    def stream(session, servers, topic):
        asked.append((servers, topic))
        return session.readStream.schema("key string, value string").parquet(str(inbox))

    def export(df, table, url, properties):
        exported.append((table, url, properties["user"], records(df, "movieId", "avg_rating")))

    monkeypatch.setattr(job, "kafka_stream", stream)
    monkeypatch.setattr(job, "write_jdbc", export)
    monkeypatch.setattr(job, "TRIGGER", job.DRAIN)
    config = StreamConfig.from_environment({
        "MYSQL_ENABLED": str(enabled),
        "MYSQL_TABLE": "t",
        "MYSQL_JDBC_URL": "jdbc:x",
        "STREAMING_OUTPUT_PATH": str(tmp_path / "out"),
        "STREAMING_CHECKPOINT_PATH": str(tmp_path / "checkpoint"),
    })
    job.finish(job.start_realtime_stats(spark, config), timeout=60)
    assert asked == [("localhost:9092", "ratings")]
    written = spark.read.parquet(str(tmp_path / "out"))
    assert records(written, "movieId", "rating_count", "avg_rating") == [(10, 2, 4.0)]
    filled = [call for call in exported if call[3]]
    assert filled == ([("t", "jdbc:x", "root", [(10, 4.0)])] if enabled else [])


def test_missing_tables_are_registered_once(spark, tmp_path, records):
    (tmp_path / "movies").mkdir()
    (tmp_path / "movies" / "movies.csv").write_text("movieId,title\n1,A\n2,B\n")
    ensure_database(spark, "cinema", str(tmp_path / "db"))
    ensure_database(spark, "cinema")
    tables = {"movies": (str(tmp_path / "movies"), "movieId int, title string")}
    assert register_files(spark, "cinema", tables) == ["movies"]
    assert register_files(spark, "cinema", tables) == []
    assert records(read_result_table(spark, "cinema.movies")) == [(1, "A"), (2, "B")]


def test_published_tables_are_replaced_and_counted(spark, tmp_path):
    (tmp_path / "ratings.csv").write_text("u,m,r,t\n1,1,4,5\n1,1,9,5\n")
    raw = read_csv_text(spark, str(tmp_path / "ratings.csv"))
    ensure_database(spark, "cinema2", str(tmp_path / "db"))
    for _ in range(2):
        assert publish_table(raw, "cinema2", "ratings_raw", str(tmp_path / "raw")) == 2
        assert publish_table(clean_ratings(raw).valid, "cinema2", "ratings") == 1
    assert [r.rating for r in spark.table("cinema2.ratings").collect()] == [4.0]


def test_readers_keep_their_rows_while_a_table_is_replaced(spark, tmp_path, records):
    """Also where the path has quotes, and where a writer dies before the switch."""
    path = str(tmp_path / "it's `here`")
    ensure_database(spark, "cinema3", str(tmp_path / "the 'db'"))
    publish_table(spark.range(3), "cinema3", "ids", path)
    reader, broken = spark.table("cinema3.ids"), spark.range(2).withColumn("id", F.raise_error(F.lit("dies")).cast("bigint"))
    assert publish_table(spark.range(5, 9), "cinema3", "ids", path) == 4
    with pytest.raises(Exception, match="dies"):
        publish_table(broken, "cinema3", "ids", path)
    assert records(reader) == [(0,), (1,), (2,)]
    assert records(spark.table("cinema3.ids")) == [(5,), (6,), (7,), (8,)]
    assert expire_published(spark, "cinema3", "ids", 3600) == []
    assert len(expire_published(spark, "cinema3", "ids", 0)) == 2
    assert records(spark.table("cinema3.ids")) == [(5,), (6,), (7,), (8,)]
    assert publish_table(spark.range(1).withColumn("more", F.lit("x")), "cinema3", "ids", path) == 1
    assert records(spark.table("cinema3.ids")) == [(0, "x")]


def test_a_folder_of_csv_files_as_tables(spark, tmp_path, records):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "movies.csv").write_text('movieId,title\n1,"A, ""b"""\n2,B\n')
    (folder / "links.csv").write_text("movieId,link\n1,x\n")
    (folder / "notes.txt").write_text("no table")
    types = {"movies": "movieId int, title string"}
    assert missing_tables(spark, str(folder), "shelf") == ["links", "movies"]
    place = str(tmp_path / "tables")
    assert register_folder(spark, str(folder), "shelf", types, place) == {"links": 1, "movies": 2}
    assert records(spark.table("shelf.movies")) == [(1, 'A, "b"'), (2, "B")]
    assert records(spark.table("shelf.links")) == [("1", "x")]
    (folder / "movies.csv").write_text("movieId,title\n3,C\n")
    (folder / "more.csv").write_text("a\n1\n")
    assert register_folder(spark, str(folder), "shelf", types, place, only_missing=True) == {"more": 1}
    assert records(spark.table("shelf.movies")) == [(1, 'A, "b"'), (2, "B")]
    # A wrong header stops everything before any table is replaced.
    (folder / "movies.csv").write_text("title,movieId\nC,3\n")
    (folder / "links.csv").write_text("movieId,link\n7,y\n8,y\n")
    with pytest.raises(ValueError, match="header"):
        register_folder(spark, str(folder), "shelf", types, place)
    assert records(spark.table("shelf.links")) == [("1", "x")]
    (folder / "a-b.csv").write_text("x\n")
    with pytest.raises(ValueError, match="a-b"):
        register_folder(spark, str(folder), "shelf", types, place)


def test_input_tables_are_read_in_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert table(spark, "/root/testdata/sf0.001", "events").count() > 0
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
