"""Versions, increments and changes of keyed tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.workspace import broadcast_if_small


# Values of these types are updated in place by a hash aggregation.
_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def latest_version(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row with the highest ``version`` (unique per key) for each key; columns keep their order.

    Both forms keep one row per key and task before the shuffle, so a key
    rewritten in every batch does not pile up in one task. Fixed-width columns are
    aggregated by hash: all of them see the rows in the same order, and so come
    from the same row. Others would make that a sort per column, where a ranking
    that Spark limits to the first row within each task sorts only once. A null version is older than
    any other; a key with nothing else keeps one of its rows.
    """
    others = [c for c in df.columns if c not in (*keys, version)]
    if all(isinstance(df.schema[c].dataType, _FIXED_WIDTH) for c in others):
        # `max_by` passes over rows without a version.
        unversioned = F.max(version).isNull()
        newest = df.groupBy(*keys).agg(
            F.max(version).alias(version),
            *[F.when(unversioned, F.first(c)).otherwise(F.max_by(c, version)).alias(c) for c in others],
        )
        return newest.select(*df.columns)
    by_version = Window.partitionBy(*keys).orderBy(F.desc(version))
    ranked = df.withColumn("version_rank", F.row_number().over(by_version))
    return ranked.filter(F.col("version_rank") == 1).drop("version_rank")


def high_water(df: DataFrame, ts: str) -> Column:
    """The latest time in the table as a one-value subquery; the year 1 when it is empty."""
    oldest = F.lit("0001-01-01 00:00:00").cast(df.schema[ts].dataType)
    return df.agg(F.coalesce(F.max(ts), oldest)).scalar()


def incremental_delta(df: DataFrame, ts: str, after: Column) -> DataFrame:
    """Rows newer than ``after``, a literal or :func:`high_water` of the table already built.

    Either reaches the scan as a pushed filter, so older row groups are skipped.
    """
    return df.filter(F.col(ts) > after)


def _same_key(keys: Sequence[str], prefix: str) -> Column:
    """Equal keys, null equal to null, where the other side's keys carry ``prefix``."""
    return reduce(and_, (F.col(f"`{k}`").eqNullSafe(F.col(f"`{prefix}{k}`")) for k in keys))


def _reconciled(
    base: DataFrame, delta: DataFrame, keys: Sequence[str], version: str
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``base`` that stand, and the newest row of ``delta`` for each key where it stands.

    A delta row older than the base's row of its key changes nothing; of equal versions the
    delta wins, and a null version is older than any other. Without a version in ``base`` the delta always wins. The
    delta is reduced and written once; a small one is broadcast by measured size, so
    ``base`` is not shuffled. Any other is merged: its keys take a small part of compressed files, and by their
    size Spark would broadcast millions of them, whole to each task's memory.
    """
    newest = broadcast_if_small(latest_version(delta, keys, version), "delta")
    mark = "delta_"
    heads = newest.select(
        *[F.col(f"`{k}`").alias(f"{mark}{k}") for k in keys], F.col(version).alias(f"{mark}{version}")
    )
    same = _same_key(keys, mark)
    # A broadcast hint of the other side goes before this one.
    base = base.hint("merge")
    if version not in base.columns:
        return base.join(heads, same, "left_anti"), newest
    newer = F.coalesce(
        F.col(version) > F.col(f"{mark}{version}"),
        F.col(version).isNotNull() & F.col(f"{mark}{version}").isNull(),
    )
    kept = base.join(heads, same & ~newer, "left_anti")
    # Late rows of the delta: no more than it has keys.
    late = base.join(heads, same & newer).select(*[F.col(f"{mark}{k}") for k in keys]).distinct()
    return kept, newest.join(late, same, "left_anti")


def merge_upsert(
    base: DataFrame, delta: DataFrame, keys: Sequence[str], version: str
) -> DataFrame:
    """``base`` with the newest ``delta`` row in place of each key it names, and new keys added.

    Rules for versions and nulls are those of :func:`_reconciled`: a replayed or late delta undoes nothing.
    """
    kept, newest = _reconciled(base, delta, keys, version)
    return kept.select(*base.columns).unionByName(newest.select(*base.columns))


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    version: str,
    op: str = "op",
    delete: str = "D",
) -> DataFrame:
    """``base`` after updates and deletes: the newest change of a key wins, ``delete`` removes it.

    A change older than the base's row is late and changes nothing, where ``base`` has versions.
    """
    kept, newest = _reconciled(base, changes, keys, version)
    upserts = newest.filter(~F.col(op).eqNullSafe(F.lit(delete)))
    return kept.select(*base.columns).unionByName(upserts.select(*base.columns))


def partial_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Statistics that can be merged: count, sum, max and min per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(value).alias("total"),
        F.max(value).alias("highest"),
        F.min(value).alias("lowest"),
    )


def merge_stats(base: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two results of :func:`partial_stats` as one, without going back to the rows behind them."""
    return (
        base.unionByName(delta)
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("n"),
            F.sum("total").alias("total"),
            F.max("highest").alias("highest"),
            F.min("lowest").alias("lowest"),
        )
    )
