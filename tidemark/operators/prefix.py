"""Byte-budget prefixes: the longest run of leading lines that fits a size.

A line costs its UTF-8 bytes plus a newline. The prefix ends at the first line
that would exceed the budget, even if a later, shorter one would still fit.

A running sum over one global window would put all lines into one task. Here the
lines are cut into ordered pieces, the pieces' totals locate the one piece per
group in which the budget runs out, and only that piece gets a running sum.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.workspace import broadcast_if_small, shared_table

DEFAULT_BUDGET = 300 * 1024 * 1024
NEWLINE_BYTES = 1
BYTE_ORDER_MARK_BYTES = 3

#: Shares of the rows at which the order column is cut, each four times the one before.
QUANTILES = tuple(4.0**-k for k in range(6, 0, -1))
_RANKED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def line_bytes(text: Column | str) -> Column:
    """UTF-8 bytes of a line with its newline."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + NEWLINE_BYTES


def byte_prefix(
    df: DataFrame,
    text: str,
    order: str,
    budget: int = DEFAULT_BUDGET,
    header_bytes: int = 0,
    group: str | None = None,
    pieces: int | None = None,
    max_piece_rows: int = 1_000_000,
) -> DataFrame:
    """Rows of ``df`` that precede, by the unique column ``order``, the first overflow of ``budget``.

    With ``group`` every group has its own budget. ``header_bytes`` counts
    against the budget beforehand. A row whose ``order`` is null has no place: it is an error. Without a group the answer is a plain filter
    ``order < bound``, which reaches the scan; and only texts near the beginning of the order are read to find
    it (:func:`_leading_rows`).
    """
    groups = [group] if group else []
    place = F.when(F.col(order).isNull(), F.raise_error(F.lit(f"{order} is null"))).otherwise(F.col(order))
    budget = max(budget - header_bytes, 0)
    near = df if groups else _leading_rows(df, text, order, budget)
    bounds = _overflow(
        near.select(*groups, place.alias(order), line_bytes(text).alias("bytes")),
        groups,
        order,
        budget,
        pieces or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2),
        max_piece_rows,
    )
    if not groups:
        bound = bounds.first()
        if bound is None:
            return df
        return df.filter(F.col(order) < _literal(bound["overflow"], df.schema[order].dataType))
    # One row per group that overflows.
    cut = _attach(df, broadcast_if_small(bounds, "prefix-bounds"), groups, "left")
    fits = F.col("overflow").isNull() | (F.col(order) < F.col("overflow"))
    return cut.filter(fits).select(*df.columns)


def _literal(value, kind: T.DataType) -> Column:
    # A zone-less time has to reach the plan without passing through a zone.
    literal = F.lit(str(value)) if isinstance(kind, T.TimestampNTZType) else F.lit(value)
    return literal.cast(kind)


def up_to(df: DataFrame, order: str, bound) -> DataFrame:
    """Rows whose ``order`` is not beyond ``bound``; all without one. The filter reaches the scan."""
    return df if bound is None else df.filter(F.col(order) <= _literal(bound, df.schema[order].dataType))


def _leading_rows(df: DataFrame, text: str, order: str, budget: int) -> DataFrame:
    """Rows up to some bound of ``order`` that cost more than ``budget``, or all rows.

    The bound comes from quantiles of the order column alone. A line costs a byte at least, so first the range is
    narrowed, without any text, to some multiple of ``budget`` rows; then the bound grows from
    its least quantile on, by what the lines before it cost, until they exceed the budget. Texts beyond the last bound are never
    read. Orders that have no quantiles (texts) are taken whole.
    """
    if not isinstance(df.schema[order].dataType, _RANKED):
        return df
    scope, count, bounds = None, None, []
    while True:
        rows = up_to(df, order, scope)
        found = rows.agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col(order).isNull()).alias("nulls"), F.percentile_approx(order, list(QUANTILES), F.lit(10_000)).alias("bounds")
        ).first()
        if found.nulls:
            raise ValueError(f"{order} is null")
        if count is not None and found.n <= budget:
            break  # the sketch was off: stay with the wider range
        count, scope_of, bounds = found.n, scope, list(found.bounds or [])
        inner = next((b for q, b in zip(QUANTILES, bounds) if q * count > 2 * (budget + 1)), None)
        if inner is None or inner == scope:
            break
        scope = inner
    least = 0.0
    for share, bound in zip(QUANTILES, bounds):
        if share < least:
            continue
        spent, n = up_to(df, order, bound).agg(F.sum(line_bytes(text)), F.count(F.lit(1))).first()
        if spent is not None and spent > budget:
            return up_to(df, order, bound)
        # The next bound to try is the first that should do by the mean cost of a line so far.
        least = 1.2 * (budget + 1) / (spent / n) / count if n else 0.0
    return up_to(df, order, scope_of)


def _attach(df: DataFrame, bounds: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join in which a null key is a group like any other."""
    renamed = bounds.withColumnsRenamed({k: f"bound_{k}" for k in keys})
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"bound_{k}")) for k in keys))
    return df.join(renamed, same, how).drop(*(f"bound_{k}" for k in keys))


def _overflow(
    sizes: DataFrame, groups: list[str], order: str, budget: int, pieces: int, max_rows: int
) -> DataFrame:
    """Per group that exceeds ``budget``: the ``order`` value of its first line beyond it."""
    # Range partitioning reads its input twice, first to sample it. Keys and sizes
    # are written down beforehand, so that the texts are read once.
    frame = shared_table(sizes, "sizes").withColumn("before", F.lit(0).cast("bigint"))
    rows = None
    while True:
        # Sampled bounds may differ between two evaluations, so piece numbers are
        # written down too.
        ranged = shared_table(
            frame.repartitionByRange(pieces, *groups, order).withColumn(
                "piece", F.spark_partition_id()
            ),
            "prefix",
        )
        totals = ranged.groupBy(*groups, "piece").agg(
            F.min("before").alias("base"),
            F.sum("bytes").alias("bytes"),
            F.count(F.lit(1)).alias("row_count"),
            (F.min(order) < F.max(order)).alias("separable"),
        )
        # At most `pieces` rows plus one per group.
        running = F.col("base") + F.sum("bytes").over(
            Window.partitionBy(*groups).orderBy("piece")
        )
        crossing = (
            totals.withColumn("after", running)
            .withColumn("before", F.col("after") - F.col("bytes"))
            .filter((F.col("before") <= budget) & (F.col("after") > budget))
            .select(*groups, "piece", "before", "row_count", "separable")
        )
        crossing = broadcast_if_small(crossing, "prefix-pieces")
        frame = _attach(ranged.drop("before"), crossing, [*groups, "piece"], "inner").drop(
            "piece", "row_count", "separable"
        )
        too_long = crossing.filter(F.col("row_count") > max_rows)
        largest, separable = too_long.agg(F.max("row_count"), F.min("separable")).first()
        if largest is None:
            break
        if not separable:
            raise ValueError(f"rows have the same {order}, which has to be unique")
        if largest == rows:
            pieces *= 4  # pieces of many groups
        rows = largest
    spent = F.col("before") + F.sum("bytes").over(Window.partitionBy(*groups).orderBy(order))
    beyond = frame.withColumn("spent", spent).filter(F.col("spent") > budget)
    if groups:
        return beyond.groupBy(*groups).agg(F.min(order).alias("overflow"))
    return beyond.orderBy(order).select(F.col(order).alias("overflow")).limit(1)


def text_file_prefix(
    spark: SparkSession, paths: str | list[str], budget: int = DEFAULT_BUDGET, glob: str | None = None
) -> DataFrame:
    """Leading lines of every text file under ``paths``, each file within ``budget`` bytes.

    Gives (file, block, position, line, is_header); lines of a file are in order
    of (block, position). The first line of a file is its header: it is always
    kept and counts. A file that is no larger than ``budget`` is kept whole, also when its last line
    has no newline. ``glob`` selects files by name. The scan's own splits are the pieces here, so
    nothing is shuffled but one total per split. (A compressed file is a single split; its lines
    count as unpacked.)
    """
    # Split bounds may move between two scans, for instance when executors come
    # and go, so lines are scanned once and written down. A line costs at least
    # half of its raw bytes (a bare CR LF counts as one), so what lies behind
    # twice the budget and a byte order mark cannot be part of a prefix and is not kept.
    reader = spark.read if glob is None else spark.read.option("pathGlobFilter", glob)
    lines = shared_table(
        reader.text(paths)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("position"),
            F.col("value").alias("line"),
            line_bytes("value").alias("bytes"),
        )
        .filter(F.col("block") <= 2 * budget + BYTE_ORDER_MARK_BYTES),
        "lines",
    )
    totals = lines.groupBy("file", "block").agg(
        F.sum("bytes").alias("bytes"), F.min("position").alias("first"), F.max("size").alias("size")
    )
    after = F.sum("bytes").over(Window.partitionBy("file").orderBy("block"))
    crosses = (F.col("before") <= budget) & (F.col("after") > budget)
    per_file = (
        totals.withColumn("after", after)
        .withColumn("before", F.col("after") - F.col("bytes"))
        .groupBy("file")
        .agg(
            F.min_by("first", "block").alias("header"),
            F.max(F.when(crosses, F.col("block"))).alias("cut_block"),
            F.max(F.when(crosses, F.col("before"))).alias("before"),
            # An overflow by the newline that the last line lacks is none. (Lines of a compressed
            # file take more than its size.)
            ((F.max("size") <= budget) & (F.max("after") <= F.max("size") + NEWLINE_BYTES)).alias("fits"),
        )
        .withColumn("cut_block", F.when(~F.col("fits"), F.col("cut_block")))
        .drop("fits")
    )
    placed = lines.join(broadcast_if_small(per_file, "lines-per-file"), "file").withColumn(
        "is_header", F.col("position") == F.col("header")
    )
    whole = placed.filter(F.col("cut_block").isNull() | (F.col("block") < F.col("cut_block")))
    in_split = Window.partitionBy("file", "block").orderBy("position")
    cut = (
        placed.filter(F.col("block") == F.col("cut_block"))
        .withColumn("spent", F.col("before") + F.sum("bytes").over(in_split))
        .filter((F.col("spent") <= budget) | F.col("is_header"))
    )
    columns = ["file", "block", "position", "line", "is_header"]
    return whole.select(*columns).unionByName(cut.select(*columns))
