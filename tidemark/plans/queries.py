"""Registered queries: each callable takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import as_event_time, epoch_to_timestamp, fixed_point
from tidemark.operators import analysis, behaviour, incremental, quantiles, validate
from tidemark.operators.clean import CORRUPT, CleanResult, clean_ratings
from tidemark.operators.cross_rules import Refers, Unique, check_rows
from tidemark.operators.events import (
    decode_payload,
    encode_events,
    parse_json_records,
    parse_ratings,
    range_filter,
)
from tidemark.operators.ledger import Ledger
from tidemark.operators.prefix import byte_prefix, text_file_prefix
from tidemark.operators.profile import file_profile, table_profile
from tidemark.operators.stats import key_avg, key_stats, windowed_stats
from tidemark.plans.batch_job import run_batch
from tidemark.plans.tables import rating_lines, rating_texts, ratings, table
from tidemark.sinks import BatchWriter, ensure_database, publish_table, read_batches, write_csv
from tidemark.sinks import catalog
from tidemark.sinks.batches import BATCH
from tidemark.sinks.compaction import compact_batches, expire_batches, read_compacted
from tidemark.sinks.keyed import KeyedTable
from tidemark.sources import csv_lines, read_csv_text, read_table, stream_files
from tidemark.streaming import late
from tidemark.streaming.job import DRAIN, finish, rating_stats, start_batches, start_landing
from tidemark.workspace import run_dir

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

RATING_FIELDS = ["userId", "movieId", "rating", "timestamp"]


def _register(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _without_zone(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# Windowed statistics


@_register
def tumbling_stats_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_stats(table(spark, sf_dir, "events"), "ts", "event_type", "value")


def _drained(df: DataFrame, writer: BatchWriter, checkpoint: str) -> None:
    finish(start_batches(df, writer, checkpoint, DRAIN))


def _latest_stats(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    versions = read_batches(spark, path, schema)
    latest = incremental.latest_version(versions, ["window_start", "window_end", key], BATCH)
    return _without_zone(latest.drop(BATCH), "window_start", "window_end")


def _event_stats(stream: DataFrame) -> DataFrame:
    timed = stream.withColumn("ts", as_event_time("ts"))
    return windowed_stats(timed, "ts", "event_type", "value", watermark="1 minute")


@_register
def stream_tumbling_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # A glob, as a stream source takes no single file.
    stats = _event_stats(stream_files(spark, f"{sf_dir}/events.parquet*", "parquet", schema))
    out = run_dir(spark, "stream_tumbling_stats")
    _drained(stats, BatchWriter(f"{out}/stats"), f"{out}/checkpoint")
    return _latest_stats(spark, f"{out}/stats", stats.schema, "event_type")


def _stats_in_thirds(spark: SparkSession, sf_dir: str, out: str, then: Callable[[T.StructType], object] = lambda schema: None) -> T.StructType:
    """Events arrive in three parts by time; the stream stops after each, ``then`` runs, and it resumes."""
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    third = (last - first) / 3
    cuts = [first, first + third, first + 2 * third, last + dt.timedelta(days=1)]
    stats = _event_stats(stream_files(spark, f"{out}/landing*", "parquet", events.schema))
    for lo, hi in zip(cuts, cuts[1:]):
        bounds = [F.lit(x.isoformat(sep=" ")).cast("timestamp_ntz") for x in (lo, hi)]
        part = events.filter((F.col("ts") >= bounds[0]) & (F.col("ts") < bounds[1]))
        part.write.mode("append").parquet(f"{out}/landing")
        _drained(stats, BatchWriter(f"{out}/stats"), f"{out}/checkpoint")
        then(stats.schema)
    return stats.schema


@_register
def stream_multibatch_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data arrives in three parts by time; the query stops after each and resumes from its checkpoint."""
    out = run_dir(spark, "stream_multibatch_latest")
    schema = _stats_in_thirds(spark, sf_dir, out)
    return _latest_stats(spark, f"{out}/stats", schema, "event_type")


@_register
def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a compaction after each part, and old files deleted at the end."""
    out, keys = run_dir(spark, "stream_compacted"), ["window_start", "window_end", "event_type"]
    schema = _stats_in_thirds(spark, sf_dir, out, lambda schema: compact_batches(spark, f"{out}/stats", schema, keys))
    compact_batches(spark, f"{out}/stats", schema, keys, with_newest=True)
    expire_batches(spark, f"{out}/stats", keep_seconds=0)
    latest = incremental.latest_version(read_compacted(spark, f"{out}/stats", schema), keys, BATCH)
    return _without_zone(latest.drop(BATCH), "window_start", "window_end")


@_register
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data arrives in four parts by time, a fifth of it one part later. Late rows are counted and taken in again."""
    events, out = table(spark, sf_dir, "events"), run_dir(spark, "stream_late_rows")
    at = F.unix_micros(as_event_time("ts"))
    first, last = events.agg(F.min(at), F.max(at)).first()
    quarter = F.floor((at - first) * 4 / (last - first + 1))
    arrives = F.least(quarter + F.when(F.col("event_id") % 5 == 0, 1).otherwise(0), F.lit(3))
    rows = stream_files(spark, f"{out}/landing*", "parquet", events.schema).withColumn("ts", as_event_time("ts"))
    writer = late.LateAwareWriter(f"{out}/stats", "ts", "event_type", "value", scale=2)
    for part in range(4):
        events.filter(arrives == part).write.mode("append").parquet(f"{out}/landing")
        _drained(rows, writer, f"{out}/checkpoint")
    stats = late.reconciled_stats(late.read_parts(spark, f"{out}/stats"), "event_type", "value", scale=2)
    return _without_zone(stats, "window_start", "window_end")


@_register
def stream_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with a checkpoint each, one for either half of the time, into the same output."""
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    # At a full minute, so that no window has rows in both halves.
    middle = (first + (last - first) / 2).replace(second=0, microsecond=0)
    early = F.col("ts") < F.lit(middle.isoformat(sep=" ")).cast("timestamp_ntz")
    out = run_dir(spark, "stream_new_checkpoint")
    for half, rows in (("early", events.filter(early)), ("late", events.filter(~early))):
        rows.write.parquet(f"{out}/{half}")
        stats = _event_stats(stream_files(spark, f"{out}/{half}*", "parquet", events.schema))
        _drained(stats, BatchWriter(f"{out}/stats"), f"{out}/checkpoint-{half}")
    return _latest_stats(spark, f"{out}/stats", stats.schema, "event_type")


def _land_json(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Ratings as JSON-lines files of records, and the stream over them."""
    messages = encode_events(ratings(table(spark, sf_dir, "events")), "userId", RATING_FIELDS)
    decode_payload(messages).write.json(path)
    return stream_files(spark, path, "json", "json string")


@_register
def stream_rating_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_dir(spark, "stream_rating_stats")
    stats = rating_stats(_land_json(spark, sf_dir, f"{out}/input"))
    _drained(stats, BatchWriter(f"{out}/stats"), f"{out}/checkpoint")
    return _latest_stats(spark, f"{out}/stats", stats.schema, "movieId")


@_register
def stream_land_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_dir(spark, "stream_land_raw")
    parsed = parse_ratings(_land_json(spark, sf_dir, f"{out}/input"))
    finish(start_landing(parsed, f"{out}/ratings", f"{out}/checkpoint", DRAIN))
    landed = read_table(spark, f"{out}/ratings", "parquet", parsed.schema)
    return _without_zone(landed, "event_timestamp")


# Parsing


@_register
def json_parse_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return parse_json_records(table(spark, sf_dir, "events"), schema, "props")


@_register
def json_roundtrip_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records encoded, damaged by item number, sent as bytes, decoded and parsed."""
    source = ratings(table(spark, sf_dir, "events"))
    k, value = F.col("k"), F.col("value")
    damaged = (
        F.when(k == 0, "not json")
        .when(k == 1, "")
        .when(k == 2, F.concat(F.lit("["), value, F.lit(",1]")))
        .when(k == 3, F.regexp_replace(value, r'"rating":([0-9.]+)', r'"rating":"$1"'))
        .when(k == 4, F.regexp_replace(value, r'"userId":([0-9]+)', r'"userId":$1.5'))
        .when(k == 5, F.regexp_replace(value, '"userId"', '"USERID"'))
        .when(k == 6, F.regexp_replace(value, r'"timestamp":[0-9]+', '"timestamp":null'))
        .when(k == 7, F.regexp_replace(value, r'"userId":([0-9]+)', r'"userId":99999999999$1'))
        .when(k == 8, F.regexp_replace(value, r"}$", ""))
        .when(k == 9, F.regexp_replace(value, r"}$", ',"more":[1,{}]}'))
        .when(k == 10, F.concat(value, F.lit(" trailing")))
        .otherwise(value)
    )
    item = F.get_json_object("value", "$.movieId").cast("int")
    messages = encode_events(source, "userId", RATING_FIELDS).withColumn("k", item)
    messages = messages.select("key", damaged.cast("binary").alias("value"))
    return _without_zone(parse_ratings(decode_payload(messages)), "event_timestamp")


@_register
def epoch_to_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    epochs = table(spark, sf_dir, "events").select(
        "event_id", F.unix_seconds(as_event_time("ts")).alias("event_time")
    )
    return _without_zone(
        epochs.withColumn("event_timestamp", epoch_to_timestamp("event_time")), "event_timestamp"
    )


# Cleaning


def _cleaned(spark: SparkSession, sf_dir: str, **options) -> CleanResult:
    return clean_ratings(csv_lines(rating_lines(table(spark, sf_dir, "events"))), **options)


@_register
def clean_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).valid


@_register
def clean_valid_wide_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir, lo=10.0, hi=100.0).valid


@_register
def clean_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).rejects.select("movieId", "rating", validate.REASON)


@_register
def clean_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).metrics


@_register
def clean_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).reasons


@_register
def csv_scan_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text fields through a directory of CSV files and back."""
    out = run_dir(spark, "csv_scan_clean")
    write_csv(rating_texts(table(spark, sf_dir, "events")), out)
    return clean_ratings(read_csv_text(spark, out)).valid


@_register
def csv_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, with their line breaks and quotes, through CSV files that any number of tasks read."""
    out = run_dir(spark, "csv_quoted_breaks")
    columns = ["doc_id", "source", "text", "n_chars"]
    write_csv(table(spark, sf_dir, "documents").select(*columns), out)
    rows = read_csv_text(spark, out, columns, multi_line=True)
    return rows.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "source",
        F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"),
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.col(CORRUPT).isNotNull().alias("damaged"),
    )


@_register
def range_filter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return range_filter(lines, "l_quantity", 10.0, 20.0).select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity"
    )


@_register
def validate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        ("price", F.col("o_totalprice").between(1_000.0, 400_000.0)),
        ("status", F.col("o_orderstatus").isin("O", "F")),
        ("priority", F.col("o_orderpriority") != "5-LOW"),
    ]
    checked = validate.with_reject_reason(table(spark, sf_dir, "orders"), rules)
    return validate.reject_counts(checked)


@_register
def validate_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines by rules across rows: the order is there, and no earlier line of it has the same supplier."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    rules = [
        ("order", Refers(("l_orderkey",), orders, ("o_orderkey",))),
        ("quantity", F.col("l_quantity") <= 49),
        ("supplier", Unique(("l_orderkey", "l_suppkey"), ("l_linenumber", "l_partkey"))),
    ]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return validate.rejected_rows(check_rows(lines, rules))


# Grouped statistics and analyses


@_register
def key_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_avg(table(spark, sf_dir, "lineitem"), "l_partkey", "l_quantity", scale=2)


@_register
def key_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_stats(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_extendedprice", scale=2)


@_register
def key_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles of few keys with many values each."""
    lines = table(spark, sf_dir, "lineitem")
    return quantiles.key_quantiles(lines, ["l_returnflag"], "l_extendedprice", [1, 10, 250, 500, 900, 999, 1000], scale=2)


@_register
def value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.value_histogram(table(spark, sf_dir, "lineitem"), "l_quantity")


@_register
def top_k_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return analysis.top_keys(lines, "l_partkey", "l_quantity", k=20, min_count=5, scale=2)


@_register
def genre_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    parts = table(spark, sf_dir, "part")
    return analysis.category_stats(
        facts, parts, "p_partkey", "l_quantity", "p_name", separator=" ", scale=2
    )


@_register
def time_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.stats_by_month(
        table(spark, sf_dir, "lineitem"), "l_shipdate", "l_extendedprice", scale=2
    )


@_register
def time_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.stats_by_hour(table(spark, sf_dir, "events"), "ts", "value", scale=2)


@_register
def user_behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return analysis.user_behaviour(events, "user_id", "event_type", "value", "ts", scale=2)


@_register
def user_behaviour_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as users and parts as items: kept parts of the earlier shipments, merged with those of the later ones."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_quantity", "l_shipdate")
    early = F.col("l_shipdate") < F.lit("1995-06-01").cast("timestamp_ntz")
    out, numbers, kept = run_dir(spark, "user_behaviour_incremental"), None, None
    for step, rows in enumerate((lines.where(early), lines.where(~early))):
        numbers = behaviour.item_numbers(rows, "l_partkey", numbers)
        parts = behaviour.user_parts(rows, "l_suppkey", "l_partkey", "l_quantity", "l_shipdate", 2, numbers)
        parts = parts if kept is None else kept.merged(parts)
        parts.write(f"{out}/{step}")
        kept = behaviour.read_parts(spark.read, f"{out}/{step}", "l_suppkey", 2)
    return kept.behaviour()


# Increments, versions and changes


@_register
def incremental_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    processed = events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    newer = incremental.incremental_delta(events, "ts", incremental.high_water(processed, "ts"))
    return newer.select("event_id", "ts", "user_id", "event_type", "value")


@_register
def incremental_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries of events, with rows of old times and rows that were delivered before; each event is picked up once."""
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    events = table(spark, sf_dir, "events").select(*columns)
    late, early = F.col("event_id") % 3 == 0, F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    deliveries = [early & ~late, early & (late | (F.col("event_id") % 5 == 0)), ~early | (F.col("event_id") % 7 == 0)]
    out = run_dir(spark, "incremental_late")
    ledger = Ledger(spark, f"{out}/ledger", f"{out}/landing", events.schema, ["event_id"])
    for rows in deliveries:
        events.where(rows).write.mode("append").parquet(f"{out}/landing")
        increment = ledger.pending()
        BatchWriter(f"{out}/picked")(increment.rows, increment.number)
        increment.commit()
    return read_batches(spark, f"{out}/picked", events.schema).select(*columns)


@_register
def latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return incremental.latest_version(events, ["user_id", "event_type"], "event_id")


def _order_version(
    orders: DataFrame, version: int, since: str | None, until: str | None, extra: float
) -> DataFrame:
    placed = F.col("o_orderdate")
    if since:
        orders = orders.filter(placed >= F.lit(since).cast("timestamp_ntz"))
    if until:
        orders = orders.filter(placed < F.lit(until).cast("timestamp_ntz"))
    return orders.select(
        "o_orderkey",
        (F.col("o_totalprice") + extra).alias("price"),
        F.lit(version).cast("bigint").alias("version"),
    )


@_register
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    base = _order_version(orders, 1, None, "1997-01-01", 0.0)
    delta = _order_version(orders, 2, "1995-01-01", None, 1.0).unionByName(
        _order_version(orders, 3, "1998-01-01", None, 2.0)
    )
    return incremental.merge_upsert(base, delta, ["o_orderkey"], "version")


@_register
def merge_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delta that holds replayed old rows, new ones, and new keys."""
    orders = table(spark, sf_dir, "orders")
    base = _order_version(orders, 2, None, "1997-01-01", 0.0)
    delta = _order_version(orders, 1, "1993-01-01", "1995-01-01", 1.0).unionByName(
        _order_version(orders, 3, "1996-01-01", None, 2.0)
    )
    return incremental.merge_upsert(base, delta, ["o_orderkey"], "version")


def _order_changes(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders, and changes that update and delete some of them, in three versions."""
    base = orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")

    def change(which, version: int, op: str, new_status: str) -> DataFrame:
        return base.filter(which).select(
            "o_orderkey",
            F.lit(new_status).alias("o_orderstatus"),
            "o_orderpriority",
            F.lit(version).alias("version"),
            F.lit(op).alias("op"),
        )

    changes = (
        change(status == "P", 1, "U", "O")
        .unionByName(change(status == "F", 2, "D", "F"))
        .unionByName(change(priority == "1-URGENT", 3, "U", "R"))
    )
    return base, changes


@_register
def apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, changes = _order_changes(table(spark, sf_dir, "orders"))
    return incremental.apply_changes(base, changes, ["o_orderkey"], "version")


@_register
def apply_changes_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes in three commits to a table of keyed files, each of which rewrites the files that it touches."""
    base, changes = _order_changes(table(spark, sf_dir, "orders"))
    base = base.withColumn("version", F.lit(0))
    orders = KeyedTable(spark, run_dir(spark, "apply_changes_files"), base.schema, ["o_orderkey"], "version", file_rows=20_000)
    orders.create(base)
    for version in (1, 2, 3):
        orders.apply(changes.where(F.col("version") == version), op="op")
    return orders.read().drop("version")


@_register
def merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "ts", "event_type", "user_id", fixed_point("value", 2).alias("cents")
    )
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    keys = ["event_type", "user_id"]
    base = incremental.partial_stats(events.filter(F.col("ts") < cut), keys, "cents")
    delta = incremental.partial_stats(events.filter(F.col("ts") >= cut), keys, "cents")
    return incremental.merge_stats(base, delta, keys)


# Size limits and profiles


@_register
def byte_prefix_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    kept = byte_prefix(documents, "text", "doc_id", budget=1_000_000, header_bytes=12)
    return kept.select("doc_id", "source", "n_chars")


@_register
def byte_prefix_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    kept = byte_prefix(documents, "text", "doc_id", budget=50_000, group="source")
    return kept.select("doc_id", "source", "n_chars")


@_register
def file_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as text files, several for each source, each cut to a budget: the lines kept, by hash and file."""
    out = run_dir(spark, "file_prefix")
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\r\n]", "¶")
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.col("doc_id") % 4).alias("part"), F.concat_ws(" ", "doc_id", text).alias("line")
    )
    ordered = lines.repartition("source", "part").sortWithinPartitions("source", "part", "doc_id").drop("doc_id")
    ordered.write.partitionBy("source", "part").text(out)
    kept = text_file_prefix(spark, f"{out}/source=*/part=*", budget=50_000, glob="part-*")
    return kept.select(
        F.regexp_extract("file", "/source=([^/]+)/", 1).alias("source"),
        F.regexp_extract("file", "/part=([0-9]+)/", 1).cast("int").alias("part"),
        F.md5("line").alias("line_md5"),
        "is_header",
    )


@_register
def table_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_profile(table(spark, sf_dir, "documents"), "source", "text")


@_register
def file_line_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as text files per language, profiled as files."""
    out = run_dir(spark, "file_line_profile")
    table(spark, sf_dir, "documents").select("lang", "text").write.partitionBy("lang").text(out)
    language = F.regexp_extract("file", "/lang=([^/]+)/", 1)
    return (
        file_profile(spark, f"{out}/lang=*")
        .groupBy(language.alias("lang"))
        .agg(F.sum("line_count").alias("line_count"))
    )


# Tables and formats


@_register
def read_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written and read in each file format."""
    orders = table(spark, sf_dir, "orders")
    out = run_dir(spark, "read_formats")
    read = None
    for fmt in ("csv", "json", "parquet"):
        orders.write.format(fmt).option("header", True).save(f"{out}/{fmt}")
        rows = read_table(spark, f"{out}/{fmt}", fmt, orders.schema).withColumn("fmt", F.lit(fmt))
        read = rows if read is None else read.unionByName(rows)
    return read.groupBy("fmt").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(fixed_point("o_totalprice", 2)).alias("total_cents"),
        F.min("o_orderdate").alias("first_date"),
        F.countDistinct("o_orderpriority").alias("priorities"),
    )


@_register
def publish_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw and cleaned ratings as catalog tables, counted as published."""
    out = run_dir(spark, "publish_tables")
    lines = rating_lines(table(spark, sf_dir, "events"))
    ensure_database(spark, "tidemark", out)
    publish_table(lines, "tidemark", "ratings_raw", f"{out}/ratings_raw")
    raw = spark.table("tidemark.ratings_raw")
    publish_table(
        clean_ratings(csv_lines(raw)).valid, "tidemark", "ratings_clean", f"{out}/ratings_clean"
    )
    clean = spark.table("tidemark.ratings_clean")
    count = F.count(F.lit(1)).alias("row_count")
    return raw.groupBy(F.lit("ratings_raw").alias("table_name")).agg(count).unionByName(
        clean.groupBy(F.lit("ratings_clean").alias("table_name")).agg(count)
    )


@_register
def register_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of CSV data as tables by stem, published twice; what the second publication has."""
    out = run_dir(spark, "register_folder")
    orders, parts = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    columns = {"orders": "o_orderkey bigint, o_orderstatus string, o_totalprice double", "part": "p_partkey bigint, p_name string, p_retailprice double"}
    database = "tidemark_folder"
    for later in (False, True):
        folder = f"{out}/csv-{later}"
        write_csv(orders.select(*(c.split()[0] for c in columns["orders"].split(", "))), f"{folder}/orders.csv")
        write_csv(parts.where(F.lit(later) | (F.col("p_partkey") % 2 == 0)).select("p_partkey", "p_name", "p_retailprice"), f"{folder}/part.csv")
        catalog.register_folder(spark, folder, database, columns, f"{out}/tables")
    found = None
    for name, key, price, text in (("orders", "o_orderkey", "o_totalprice", "o_orderstatus"), ("part", "p_partkey", "p_retailprice", "p_name")):
        rows = spark.table(f"{database}.{name}").groupBy(F.lit(name).alias("table_name")).agg(
            F.count(F.lit(1)).alias("row_count"), F.sum(key).alias("keys"), F.sum(fixed_point(price, 2)).alias("cents"), F.countDistinct(text).alias("texts")
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def _batch_inputs(spark: SparkSession, sf_dir: str, out: str) -> tuple[str, str]:
    """Events as ratings files and parts as item files."""
    write_csv(rating_texts(table(spark, sf_dir, "events")), f"{out}/ratings")
    movies = table(spark, sf_dir, "part").select(
        "p_partkey", "p_type", F.translate("p_name", " ", "|").alias("genres")
    )
    write_csv(movies, f"{out}/movies")
    return f"{out}/ratings", f"{out}/movies"


@_register
def batch_job_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job on events as ratings and parts as items; gives its category result."""
    out = run_dir(spark, "batch_job_genres")
    run_batch(spark, *_batch_inputs(spark, sf_dir, out), f"{out}/results", scale=2)
    return read_table(spark, f"{out}/results/genre_stats", "parquet")


@_register
def batch_job_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other six results of the batch job, each as (key, rows, mean or share)."""
    out = run_dir(spark, "batch_job_results")
    inputs = _batch_inputs(spark, sf_dir, out)
    run_batch(spark, *inputs, f"{out}/results", scale=2, top=5, min_count=2)
    cents = F.rint(F.col("rating") * 100)
    month = F.year("month") * 100 + F.month("month")
    parts = {
        "movie_stats": (F.col("movieId"), "rating_count", "avg_rating"),
        "top_movies": (F.col("movieId"), "rating_count", "avg_rating"),
        "rating_histogram": (cents, "row_count", "share"),
        "month_stats": (month, "row_count", "avg_value"),
        "hour_stats": (F.col("hour"), "row_count", "avg_value"),
        "user_stats": (F.col("userId"), "row_count", "avg_value"),
    }
    results = None
    for name, (key, n, measure) in parts.items():
        rows = read_table(spark, f"{out}/results/{name}", "parquet").select(
            F.lit(name).alias("result"), key.cast("bigint").alias("key"), F.col(n).alias("n"), F.col(measure).alias("measure")
        )
        results = rows if results is None else results.unionByName(rows)
    return results


@_register
def batch_job_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batch job counts without a budget and with one above the size of the files."""
    out = run_dir(spark, "batch_job_counters")
    inputs = _batch_inputs(spark, sf_dir, out)
    counted = None
    for budget in (None, 1 << 50):
        counters = run_batch(spark, *inputs, f"{out}/results", budget=budget, scale=2)
        row = spark.range(1).select(
            F.lit(budget is not None).alias("with_budget"),
            *[F.lit(n).cast("bigint").alias(name) for name, n in counters.items()],
        )
        counted = row if counted is None else counted.unionByName(row)
    return counted
