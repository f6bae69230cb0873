"""Behaviour of users from parts that can be kept and merged: no recount when rows are added.

Sums, counts and ranges add up. Distinct items and days don't, so they are kept as bits: every item has a dense number, and
a user's items are words of 64 bits, a row for each word that isn't empty. Two users' parts are combined by ``bit_or``; the
number of distinct items is the number of bits. The result is that of
:func:`~tidemark.operators.analysis.user_behaviour` over all rows, whatever rows the parts came from; only
rows that are counted twice would show, so merge each increment once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import exact_sum, fixed_point
from tidemark.workspace import shared_table


def item_numbers(items: DataFrame, item: str, known: DataFrame | None = None) -> DataFrame:
    """``item`` and ``number`` from 0 without gaps: ``known`` as it is, and numbers that follow it for further items.

    Null is no item. New items are numbered in parallel, in pieces of an order.
    """
    new = items.select(item).where(F.col(item).isNotNull()).distinct()
    start = 0
    if known is not None:
        new = new.join(known.select(item), item, "left_anti")
        start = F.coalesce(known.agg(F.max("number")).scalar() + 1, F.lit(0))
    new = shared_table(new, "new-items")
    # In a piece of the order this number grows by one from row to row.
    placed = new.repartitionByRange(F.col(item)).sortWithinPartitions(item)
    placed = shared_table(placed.withColumn("piece", F.spark_partition_id()).withColumn("line", F.monotonically_increasing_id()), "item-order")
    pieces = placed.groupBy("piece").agg(F.min("line").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row for each piece
    pieces = pieces.select("piece", (F.sum("n").over(before) - F.col("n") - F.col("first")).alias("shift"))
    numbered = placed.join(pieces, "piece").select(item, (F.col("line") + F.col("shift") + start).cast("bigint").alias("number"))
    numbered = shared_table(numbered if known is None else known.select(item, "number").unionByName(numbered), "item-numbers")
    return numbered


def _words(df: DataFrame, user: str, place: Column) -> DataFrame:
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("place", F.lit(64)).cast("int"))
    rows = df.select(user, place.cast("bigint").alias("place")).where("place IS NOT NULL")
    return rows.groupBy(user, F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


@dataclass(frozen=True)
class UserParts:
    """Three tables to keep: sums for each user, words of items and words of days for each user."""

    totals: DataFrame
    items: DataFrame
    days: DataFrame
    user: str
    scale: int

    def write(self, path: str) -> None:
        for name in ("totals", "items", "days"):
            getattr(self, name).write.parquet(f"{path}/{name}")

    def merged(self, other: UserParts) -> UserParts:
        """The parts of both sets of rows."""
        if (self.user, self.scale) != (other.user, other.scale):
            raise ValueError("parts of different kind")
        sums = [F.sum(c).cast(self.totals.schema[c].dataType).alias(c) for c in ("n", "n_value", "total", "squares")]
        ends = [F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")]
        words = lambda a, b: a.unionByName(b).groupBy(self.user, "word").agg(F.bit_or("bits").alias("bits"))
        return UserParts(
            self.totals.unionByName(other.totals).groupBy(self.user).agg(*sums, *ends),
            words(self.items, other.items),
            words(self.days, other.days),
            self.user,
            self.scale,
        )

    def behaviour(self) -> DataFrame:
        """The columns of :func:`~tidemark.operators.analysis.user_behaviour`."""
        units, n = F.lit(float(10**self.scale)), F.nullif(F.col("n_value").cast("double"), F.lit(0.0))
        mean = F.col("total").cast("double") / (n * units)
        spread = (F.col("n_value").cast("decimal(18,0)") * F.col("squares")).cast("decimal(38,0)") - (F.col("total").cast("decimal(19,0)") * F.col("total").cast("decimal(19,0)"))
        totals = self.totals.select(
            self.user, F.col("n").alias("row_count"), mean.alias("avg_value"),
            F.round(F.sqrt(spread.cast("double")) / (n * units), 6).alias("stddev_value"), "first_seen", "last_seen",
        )
        count = lambda words, name: words.groupBy(self.user).agg(F.sum(F.bit_count("bits")).cast("bigint").alias(name))
        parts = totals.unionByName(count(self.items, "item_count"), allowMissingColumns=True).unionByName(count(self.days, "active_days"), allowMissingColumns=True)
        found = parts.groupBy(self.user).agg(*[F.max(c).alias(c) for c in parts.columns if c != self.user])
        none = F.lit(0).cast("bigint")
        return found.withColumns({c: F.coalesce(c, none) for c in ("item_count", "active_days")}).select(
            self.user, "row_count", "avg_value", "stddev_value", "first_seen", "last_seen", "item_count", "active_days"
        )


def user_parts(df: DataFrame, user: str, item: str, value: str, ts: str, scale: int, numbers: DataFrame) -> UserParts:
    """The parts of ``df``; ``numbers`` from :func:`item_numbers` has every item in it. ``value`` has ``scale`` decimals."""
    units = fixed_point(value, scale).cast("decimal(19,0)")
    totals = df.groupBy(user).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(value).alias("n_value"),
        exact_sum(value, scale).alias("total"),
        F.sum((units * units).cast("decimal(38,0)")).cast("decimal(38,0)").alias("squares"),
        F.min(ts).alias("first_seen"),
        F.max(ts).alias("last_seen"),
    )
    # Each pair once before the join, so that a hot item or user is a row for each task.
    pairs = df.select(user, item).where(F.col(item).isNotNull()).distinct().join(numbers, item)
    return UserParts(totals, _words(pairs, user, F.col("number")), _words(df, user, F.unix_date(F.to_date(ts))), user, scale)


def read_parts(df_reader, path: str, user: str, scale: int) -> UserParts:
    """Parts that :meth:`UserParts.write` wrote; ``df_reader`` is ``spark.read``."""
    return UserParts(*[df_reader.parquet(f"{path}/{name}") for name in ("totals", "items", "days")], user, scale)
