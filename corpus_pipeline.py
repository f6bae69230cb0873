"""A corpus in five stages: quality, repeated lines, near duplicates, benchmark leaks, token ids.

Every stage takes all that the one before kept, and handles nulls, empty and repeated rows, empty tables and
further columns as its operator states. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, line_dedup, minhash, quality
from tidemark.llm.queries import table, tokenizer
from tidemark.workspace import broadcast_if_small, shared_table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is likely of the upper grade."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).where("kept").select("row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier one has; ``n_chars`` follows the text."""
    kept = line_dedup.drop_repeated_lines(docs)
    columns = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("bigint")}
    return kept.select(*[columns[c].alias(c) if c in columns else F.col("row").getField(c).alias(c) for c in docs.columns])


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest identifier of each group of near copies: five words, similarity 0.8.

    Rows are told apart by a number of their own, so null and repeated identifiers link nothing. Null comes last; of equal
    identifiers the row with the smaller hash of its text is kept.
    """
    number = "row_number_of_stage"
    # Written once: a second scan could number the rows in another way.
    rows = shared_table(docs.withColumn(number, F.monotonically_increasing_id()), "numbered-rows")
    found = shared_table(minhash.near_duplicates(rows, key=number).select(number, "component_id"), "row-components")
    groups = found.where(F.col("component_id") != F.col(number)).select("component_id").distinct()
    members = found.join(broadcast_if_small(groups, "groups"), "component_id", "left_semi")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("hash"), number)
    ranked = shared_table(rows.join(broadcast_if_small(members, "members"), number).select("component_id", number, order.alias("order")), "group-rows")
    first = ranked.groupBy("component_id").agg(F.min("order").alias("order")).select(F.col(f"order.{number}").alias(number))
    copies = ranked.select(number).join(broadcast_if_small(first, "first-rows"), number, "left_anti")
    return rows.join(broadcast_if_small(copies, "near-copies"), number, "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified passage of a benchmark item."""
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select("row.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, and the digest of the text that they decode to."""
    coded = bpe.encode_texts(docs, tokenizer("word_bpe_49k.json"), decode=True)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", good_quality),
    ("line_dedup", without_repeated_lines),
    ("minhash_near_dedup", one_of_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("bpe_encoding", encoded),
]

#: The model of the first stage and the ids of the last can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return docs
