"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, exact_dedup, language, line_dedup, merkle, minhash, periodic, quality, sharding, token_files, toxicity, warc

#: Where the public tokenizer files are; a parameter of the operators.
TOKENIZERS = "/opt/tokenizers"
TOXIC_FROM = 0.3


def tokenizer(name: str) -> str:
    try:
        from public_tokenizers import path
    except ImportError:
        return str(Path(TOKENIZERS) / name)
    return path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_texts(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), decode=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verified leaks: document, item, BM25 share and overlaps."""
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("row.doc_id").alias("doc_id"), F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = toxicity.score_toxicity(documents, toxicity.fit_toxicity(documents, table(spark, sf_dir, "labels")))
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        toxicity.held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
        "evidence",
    )


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its expected grade, the probability of the upper grades, and the decision."""
    documents = table(spark, sf_dir, "documents")
    scored = quality.score_quality(documents, quality.fit_quality(documents, table(spark, sf_dir, "labels")))
    return scored.select(F.col("row.doc_id").alias("doc_id"), "expected_grade", "tail_probability", "kept")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    records = warc.read_archives(spark, archives, with_payload=False, strict=True)
    return records.select(
        warc.key_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.key_of("refers_to").alias("refers_to")
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.token_file_folder(spark)
    token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), folder)
    return token_files.read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of each document; a fifth of the documents are checked after a change of their text."""
    documents = table(spark, sf_dir, "documents")
    fields = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    changed = F.when(tampered, merkle.leaf_digest([*(fields | {"text": small}).values()]))
    found = merkle.merkle_manifest(documents, merkle.leaf_digest([*fields.values()]), changed=changed)
    proof = F.sha2(merkle.proof_text(), 256).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held = toxicity.held_out  # the rows that nothing is learned from are the same
    model = language.fit_languages(documents.where(~held("doc_id")))
    return language.identify_languages(documents, model).select(F.col("row.doc_id").alias("doc_id"), held("row.doc_id").alias("held_out"), "lang_pred", "score", "bits")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words of each document, after the contract's change of a tenth of them."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.detect_runs(documents, periodic.made_periodic())
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws("", F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    run = F.col("strongest")
    return found.withColumn("strongest", periodic.strongest()).select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("runs").cast("bigint").alias("n_runs"),
        run.start.alias("start"),
        run.length.alias("length"),
        run.period.alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_bpe, op2_decontamination, op3_toxicity, op4_near_duplicates, op5_quality, op6_warc, op7_token_files, op8_line_dedup, op9_exact_dedup, op10_sharding, op11_merkle_manifest, op12_language_id, op13_periodic_runs)
    return {query.__name__: query for query in every}
