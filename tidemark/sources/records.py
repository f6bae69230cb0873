"""CSV records whose quoted fields may have line breaks, from any number of tasks for each file.

Whether a line break ends a record depends on all text before it. But at a line's beginning the parser is in one of two
states only, at a record's start or inside quotes, so a line is a function from state to state, and so is a block of lines
(a split of the file) and each chunk of one: ``opens`` is where it ends up from a record's start, ``stays`` from inside quotes. A function
is either constant, forgets what came before, or passes the state on, as it is or swapped. So the state at each chunk's
beginning is the last constant before it with the swaps since, and the same holds for the lines of a chunk.

Lines are scanned once and written down. A block can be as large as a split, so it is cut by position into chunks of
some :data:`CHUNK_BYTES`. Chunks in which no field is ever open need no more; their lines are
records. Only the lines of other chunks are shuffled, by chunk, to as many tasks as their bytes ask for, and joined; what a
chunk has of a record that began in an earlier one is then added to its owner.

The rules for quotes are those of :data:`~tidemark.sources.files.CSV_OPTIONS`: a field is quoted if its first character is a
quote; a doubled quote stands for one; after the closing quote anything up to the next comma or line break belongs to
the field, further quotes included. Line breaks of any kind (LF, CR LF, CR) inside quotes are given as LF.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.workspace import broadcast_if_small, shared_table

#: Longest record, in bytes: a quote that is never closed is an error, not a task that holds the rest of the file.
MAX_RECORD_BYTES = 64 * 1024 * 1024

#: Text of a chunk, on average over its block, and of a task that joins the lines of chunks, on average over all of them.
CHUNK_BYTES = 1024 * 1024
TASK_BYTES = 32 * 1024 * 1024

#: Of the two tables that hold all text, besides the files themselves and a shuffle.
TEXT_CODEC = "zstd"

_CHUNK = ["file", "block", "chunk"]

# Possessive throughout, so that a match takes one pass and no stack.
_OPEN = r'"(?:[^"]++|"")*+'
_FIELDS = rf'(?:(?:{_OPEN}"[^,]*+|[^",][^,]*+|),)*+'
_OPENS = rf"^{_FIELDS}{_OPEN}\z"
_STAYS = rf'^(?:[^"]++|"")*+(?:\z|"[^,]*+,{_FIELDS}{_OPEN}\z)'


def line_states(line: str) -> tuple[Column, Column]:
    """Whether the text after a line is inside quotes: if its beginning is a record's start, and if it is inside quotes."""
    quoted = F.contains(F.col(line), F.lit('"'))
    return F.when(quoted, F.col(line).rlike(_OPENS)).otherwise(False), F.when(quoted, F.col(line).rlike(_STAYS)).otherwise(True)


def text_lines(spark: SparkSession, paths: str | list[str], glob: str = "*.csv") -> DataFrame:
    """All lines of text files as (file, block, position, line); those of a file are in order of (block, position)."""
    return spark.read.option("pathGlobFilter", glob).text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
        F.col("value").alias("line"),
    )


def _odd(n: Column) -> Column:
    return n % 2 == 1


def _differ(a: Column, b: Column) -> Column:
    return a != b


def _chunked(lines: DataFrame) -> DataFrame:
    """``lines`` with the number of their chunk, equal stretches of positions within each block."""
    extents = lines.groupBy("file", "block").agg(
        F.min("position").alias("begin"),
        (F.max("position") - F.min("position") + 1).alias("span"),
        F.ceil(F.sum("bytes") / CHUNK_BYTES).alias("chunks"),
    )
    placed = lines.join(broadcast_if_small(extents, "csv-blocks"), ["file", "block"])
    return placed.withColumn("chunk", F.expr("(position - begin) * chunks div span")).drop("begin", "span", "chunks")


def _chunks(lines: DataFrame) -> DataFrame:
    """For each chunk: its first line, its bytes, whether it begins inside quotes, whether it is a file's first, and whether any
    field is open at the end of one of its lines. One row for each chunk, from two passes over flags only."""
    constant = F.col("opens") == F.col("stays")
    chunks = lines.groupBy(*_CHUNK).agg(
        F.min("position").alias("first"),
        F.sum("bytes").alias("bytes"),
        F.max(F.when(constant, F.struct("position", "opens"))).alias("last"),
        F.bool_or("opens").alias("opening"),
    )
    chunks = shared_table(chunks, "csv-chunks")
    swaps = (
        lines.where(F.col("opens") & ~F.col("stays"))
        .select(*_CHUNK, "position")
        .join(chunks.select(*_CHUNK, "last"), _CHUNK)
        .where(F.col("last").isNull() | (F.col("position") > F.col("last.position")))
        .groupBy(*_CHUNK)
        .agg(F.count("*").alias("swaps"))
    )
    placed = chunks.join(swaps, _CHUNK, "left").withColumn("swaps", F.coalesce("swaps", F.lit(0)))
    # A chunk's outcome: fixed, or the state before it, swapped or not.
    fixed = _differ(F.col("last.opens"), _odd(F.col("swaps")))
    in_file = Window.partitionBy("file").orderBy("block", "chunk")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    passed = F.when(F.col("last").isNull(), F.col("swaps")).otherwise(0)
    placed = placed.withColumn("swapped", F.sum(passed).over(in_file)).withColumn("anchor", _differ(fixed, _odd(F.col("swapped"))))
    start = _differ(F.coalesce(F.last("anchor", True).over(before), F.lit(False)), _odd(F.coalesce(F.sum(passed).over(before), F.lit(0))))
    return placed.select(
        *_CHUNK, "first", F.col("bytes").alias("chunk_bytes"), start.alias("inside"), (F.row_number().over(in_file) == 1).alias("leads"), (F.col("opening") | start).alias("broken")
    )


def csv_records(lines: DataFrame, max_bytes: int = MAX_RECORD_BYTES) -> DataFrame:
    """Records as (file, block, position, record, is_header) from lines as (file, block, position, line).

    Block and position are those of a record's first line; ``is_header`` marks the first record of each file. A record
    may span any number of blocks. One of more than ``max_bytes``, line breaks included, is an error. A field that is still open at the end of a file
    ends there, without the file's last line break.
    """
    # The tables of chunks are small, and Spark sees that by their files: joins with them broadcast or shuffle by size.
    keys = _CHUNK
    opens, stays = line_states("line")
    size = F.octet_length("line").cast("bigint") + 1
    lines = lines.select("file", "block", "position", "line", size.alias("bytes"), opens.alias("opens"), stays.alias("stays"))
    lines = _chunked(shared_table(lines, "csv-lines", TEXT_CODEC))
    chunks = broadcast_if_small(_chunks(lines), "csv-chunk-states")
    header = F.col("leads") & (F.col("position") == F.col("first"))
    placed = lines.join(chunks, keys)
    columns = ["file", "block", "position", "record", "is_header"]
    plain = placed.where(~F.col("broken")).select("file", "block", "position", F.col("line").alias("record"), header.alias("is_header"))
    broken = chunks.where("broken").agg(F.sum("chunk_bytes")).first()[0]
    if broken is None:
        return plain

    # Lines of the other chunks in order, with the state before each and the number of the record they are in.
    in_chunk = Window.partitionBy(*keys).orderBy("position")
    before = in_chunk.rowsBetween(Window.unboundedPreceding, -1)
    swap = (F.col("opens") & ~F.col("stays")).cast("bigint")
    tasks = max(lines.sparkSession.sparkContext.defaultParallelism, math.ceil(broken / TASK_BYTES))
    states = (
        placed.where("broken")
        .repartition(tasks, *keys)
        .withColumn("swapped", F.sum(swap).over(in_chunk))
        .withColumn("anchor", F.when(F.col("opens") == F.col("stays"), _differ(F.col("opens"), _odd(F.col("swapped")))))
        .withColumn("begins", ~_differ(F.coalesce(F.last("anchor", True).over(before), F.col("inside")), _odd(F.col("swapped") - swap)))
        .withColumn("number", F.sum(F.col("begins").cast("bigint")).over(in_chunk))
        .withColumn("ends", F.sum("bytes").over(in_chunk))
        .withColumn("base", F.coalesce(F.last(F.when(F.col("begins"), F.col("ends") - F.col("bytes")), True).over(in_chunk), F.lit(0)))
    )
    too_long = F.raise_error(F.concat(F.lit(f"record of more than {max_bytes} bytes in "), F.col("file")))
    line = F.when(F.col("ends") - F.col("base") > max_bytes, too_long).otherwise(F.col("line"))
    joined = lambda parts: F.array_join(F.transform(F.array_sort(parts), lambda p: p.text), "\n")
    pieces = states.groupBy(*keys, "number").agg(
        F.min(F.struct("position", header.alias("is_header"))).alias("start"),
        joined(F.collect_list(F.struct("position", line.alias("text")))).alias("text"),
    )
    pieces = shared_table(pieces.select(*keys, "number", "start.*", "text"), "csv-pieces", TEXT_CODEC)

    # The head of a chunk (number 0) belongs to the last record that began in a chunk before it.
    here = F.struct("block", "chunk").alias("from")
    size = (F.octet_length("text").cast("bigint") + 1).alias("size")
    last = pieces.groupBy(*keys).agg(F.max("number").alias("last"))
    begun = F.when(F.col("last") > 0, F.struct(F.col("block"), F.col("chunk"), F.col("last").alias("number")))
    in_order = Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    owned = last.select(*keys, F.last(begun, True).over(in_order).alias("owner"))
    heads = pieces.where("number = 0").join(owned, keys).select("file", F.col("owner.*"), here, size)
    heads = shared_table(heads, "csv-heads")
    lengths = pieces.join(heads.select(*keys, "number").distinct(), [*keys, "number"]).select(*keys, "number", size)
    total = heads.select(*keys, "number", "size").unionByName(lengths).groupBy(*keys, "number").agg(F.sum("size").alias("total"))
    total = shared_table(total, "csv-spanning")
    parts = (
        pieces.where("number > 0").withColumn("from", F.struct("block", "chunk")).join(total, [*keys, "number"])
        .unionByName(
            pieces.where("number = 0").select("file", here, "position", "is_header", "text")
            .join(heads.drop("size"), ["file", "from"]).join(total, [*keys, "number"])
        )
    )
    fits = F.when(F.col("total") > max_bytes, too_long).otherwise(F.col("text"))
    spanning = parts.groupBy(*keys, "number").agg(
        F.min(F.struct("from", "position", "is_header")).alias("start"), joined(F.collect_list(F.struct("from", fits.alias("text")))).alias("record")
    )
    spanning = spanning.select("file", "block", F.col("start.position").alias("position"), "record", F.col("start.is_header").alias("is_header"))
    within = pieces.where("number > 0").join(total, [*keys, "number"], "left_anti").withColumnRenamed("text", "record")
    return plain.unionByName(within.select(*columns)).unionByName(spanning.select(*columns))
