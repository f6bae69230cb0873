"""Batch analyses of rating-like facts: distribution, ranking, categories, time, users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import exact_mean, exact_sum
from tidemark.operators.stats import key_stats


def value_histogram(df: DataFrame, value: str) -> DataFrame:
    """Rows per distinct value and their share of all non-null values."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    # The total is a one-value subquery over the counts, whose shuffle both share; a
    # window without partitions would pull all distinct values into one task.
    total = counts.agg(F.sum("row_count")).scalar()
    return counts.withColumn("share", F.col("row_count") / total)


def top_keys(
    df: DataFrame, key: str, value: str, k: int, min_count: int = 1, scale: int | None = None
) -> DataFrame:
    """The ``k`` keys with the highest mean among those with enough rows; ties by key."""
    return top_of_stats(key_stats(df, key, value, scale), key, value, k, min_count)


def top_of_stats(stats: DataFrame, key: str, value: str, k: int, min_count: int = 1) -> DataFrame:
    """:func:`top_keys` from the rows of ``key_stats``."""
    enough = stats.filter(F.col(f"{value}_count") >= min_count)
    return enough.orderBy(F.desc(f"avg_{value}"), F.asc(key)).limit(k)


def totals(df: DataFrame, key: Column | str, value: str, scale: int | None = None) -> DataFrame:
    """Per key what its count, mean and range are made of, so that several results share one scan."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(value).alias("n_value"),
        (F.sum(value) if scale is None else exact_sum(value, scale)).alias("total"),
        F.max(value).alias("highest"),
        F.min(value).alias("lowest"),
    )


def _mean(total: Column, count: Column, scale: int | None) -> Column:
    units = count.cast("double") * F.lit(float(10 ** (scale or 0)))
    return total.cast("double") / F.nullif(units, F.lit(0.0))


def stats_of_totals(per_key: DataFrame, key: str, value: str, scale: int | None = None) -> DataFrame:
    """The rows of ``key_stats`` from :func:`totals`."""
    return per_key.select(
        key,
        F.col("n").alias(f"{value}_count"),
        _mean(F.col("total"), F.col("n_value"), scale).alias(f"avg_{value}"),
        F.col("highest").alias(f"max_{value}"),
        F.col("lowest").alias(f"min_{value}"),
    )


def category_stats(
    facts: DataFrame,
    items: DataFrame,
    key: str,
    value: str,
    categories: str,
    separator: str = r"\|",
    scale: int | None = None,
) -> DataFrame:
    """Count, distinct items and mean of ``value`` per category of the item.

    ``categories`` of an item is one string, split at the regex ``separator``; a
    category listed twice counts once. Facts are summed per item before the join:
    the sums are additive, so a popular item reaches the join as a single row and
    no fact is repeated for each of its categories.
    """
    per_item = totals(facts, key, value, scale)
    return category_stats_of_totals(per_item, items, key, categories, separator, scale)


def category_stats_of_totals(
    per_item: DataFrame,
    items: DataFrame,
    key: str,
    categories: str,
    separator: str = r"\|",
    scale: int | None = None,
) -> DataFrame:
    """:func:`category_stats` from :func:`totals` per item."""
    listed = items.select(
        key, F.explode(F.array_distinct(F.split(categories, separator))).alias("category")
    )
    # No hint: item-sized sides, so Spark broadcasts by measured size or sorts.
    return (
        per_item.join(listed, key)
        .groupBy("category")
        .agg(
            F.sum("n").alias("row_count"),
            F.countDistinct(key).alias("item_count"),
            _mean(F.sum("total"), F.sum("n_value"), scale).alias("avg_value"),
        )
    )


def hourly_totals(df: DataFrame, ts: str, value: str, scale: int | None = None) -> DataFrame:
    """:func:`totals` per hour of time, in the column ``ts``: for months, hours of day and the like."""
    return totals(df, F.date_trunc("hour", ts).cast(df.schema[ts].dataType).alias(ts), value, scale)


def _of_totals(per_hour: DataFrame, group: Column, scale: int | None) -> DataFrame:
    return per_hour.groupBy(group).agg(
        F.sum("n").alias("row_count"), _mean(F.sum("total"), F.sum("n_value"), scale).alias("avg_value")
    )


def months_of_totals(per_hour: DataFrame, ts: str, scale: int | None = None) -> DataFrame:
    """:func:`stats_by_month` from :func:`hourly_totals`."""
    return _of_totals(per_hour, _month(per_hour, ts), scale)


def hours_of_totals(per_hour: DataFrame, ts: str, scale: int | None = None) -> DataFrame:
    """:func:`stats_by_hour` from :func:`hourly_totals`."""
    return _of_totals(per_hour, _hour(ts), scale)


def _month(df: DataFrame, ts: str) -> Column:
    return F.date_trunc("month", ts).cast(df.schema[ts].dataType).alias("month")


def _hour(ts: str) -> Column:
    return F.hour(ts).cast("bigint").alias("hour")


def stats_by_month(df: DataFrame, ts: str, value: str, scale: int | None = None) -> DataFrame:
    """Count and mean of ``value`` per calendar month."""
    return df.groupBy(_month(df, ts)).agg(
        F.count(F.lit(1)).alias("row_count"), exact_mean(value, scale).alias("avg_value")
    )


def stats_by_hour(df: DataFrame, ts: str, value: str, scale: int | None = None) -> DataFrame:
    """Count and mean of ``value`` per hour of day."""
    return df.groupBy(_hour(ts)).agg(
        F.count(F.lit(1)).alias("row_count"), exact_mean(value, scale).alias("avg_value")
    )


def active_days(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Distinct days with rows per key.

    Days become bits of one word per 64 days, so the aggregation keeps a word
    where a distinct count would keep and shuffle every (key, day).
    """
    day = F.unix_date(F.to_date(ts))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(day, F.lit(64)))
    words = (
        df.select(key, F.shiftright(day, 6).alias("word"), bit.alias("bit"))
        .groupBy(key, "word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    days = F.coalesce(F.sum(F.bit_count("bits")), F.lit(0))
    return words.groupBy(key).agg(days.cast("bigint").alias("active_days"))


def user_behaviour(
    df: DataFrame, user: str, item: str, value: str, ts: str, scale: int | None = None
) -> DataFrame:
    """Per user: rows, distinct items, mean and spread of ``value``, first and last time, active days.

    Two distinct counts in one aggregation would triple every row beforehand.
    Instead each part reads only its own columns, sums up within the task before
    its shuffle, and the parts meet as at most three rows per user.
    """
    totals = df.groupBy(user).agg(
        F.count(F.lit(1)).alias("row_count"),
        exact_mean(value, scale).alias("avg_value"),
        F.round(F.stddev_pop(value), 6).alias("stddev_value"),
        F.min(ts).alias("first_seen"),
        F.max(ts).alias("last_seen"),
    )
    items = df.groupBy(user).agg(F.countDistinct(item).alias("item_count"))
    days = active_days(df, user, ts)
    parts = totals.unionByName(items, allowMissingColumns=True).unionByName(
        days, allowMissingColumns=True
    )
    return parts.groupBy(user).agg(*[F.max(c).alias(c) for c in parts.columns if c != user])
