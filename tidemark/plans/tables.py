"""The input tables, and rating-shaped views that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import as_event_time


# Columns of the input tables. Reading with a schema saves the job that infers one.
SCHEMAS = {
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table. Times are UTC, so the session zone is pinned."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def props_k(props: str = "props") -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def ratings(events: DataFrame) -> DataFrame:
    """``events`` as ratings: the number in ``props`` is the item, ``value`` the rating."""
    return events.select(
        F.col("user_id").cast("int").alias("userId"),
        props_k().alias("movieId"),
        F.col("value").alias("rating"),
        F.unix_seconds(as_event_time("ts")).alias("timestamp"),
    )


def rating_texts(events: DataFrame) -> DataFrame:
    """The fields of :func:`ratings` as text, with defects that depend on the item number."""
    k = F.col("movieId")
    user, rating, time = (F.col(c).cast("string") for c in ("userId", "rating", "timestamp"))
    return ratings(events).select(
        F.when(k == 2, F.concat(F.lit("x"), user))
        .when(k == 3, F.concat(user, F.lit("_0")))
        .when(k == 4, F.concat(F.lit(" "), user, F.lit("  ")))
        .when(k == 9, F.concat(F.lit("99999999999999999999"), user))
        .when(k == 10, F.concat(F.lit("+"), user))
        .otherwise(user)
        .alias("userId"),
        k.cast("string").alias("movieId"),
        F.when(k == 6, "nan")
        .when(k == 7, "-inf")
        .when(k == 8, F.concat(rating, F.lit("e0")))
        .when(k == 12, "")
        .when(k == 13, F.concat(rating, F.lit("d")))
        .when(k == 15, "4")
        .otherwise(rating)
        .alias("rating"),
        F.when(k == 5, F.concat(time, F.lit(".0"))).otherwise(time).alias("timestamp"),
    )


def rating_lines(events: DataFrame) -> DataFrame:
    """CSV lines of :func:`rating_texts`; some lack a field, have one more, or quote all."""
    k = F.col("movieId").cast("int")
    fields = [F.col(c) for c in ("userId", "movieId", "rating", "timestamp")]
    quoted = [F.concat(F.lit('"'), c, F.lit('"')) for c in fields]
    return rating_texts(events).select(
        F.when(k == 0, F.concat_ws(",", *fields[:3]))
        .when(k == 1, F.concat_ws(",", *fields, F.lit("extra")))
        .when(k == 11, F.concat_ws(",", *quoted))
        .otherwise(F.concat_ws(",", *fields))
        .alias("line")
    )
