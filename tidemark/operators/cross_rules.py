"""Rules that a row keeps or breaks by other rows: unique keys and references.

Each rule finds the *keys* that break it by an aggregation that combines within tasks, so a key with a third of the rows
is a row for each task. Only these keys are then joined with the rows: broadcast while their measured size allows, else by a
shuffle whose hot partitions Spark splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.validate import with_reject_reason
from tidemark.workspace import broadcast_if_small


@dataclass(frozen=True)
class Unique:
    """No other row has the same values in ``columns``; rows with a null there are not checked, as in SQL.

    With ``first_by`` the row with the least values in those columns keeps the rule (all of them, if they are equal there too), and
    the others of its key break it.
    """

    columns: tuple[str, ...]
    first_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class Refers:
    """``other`` has a row whose ``to`` equals this row's ``columns``; rows with a null there are not checked, as in SQL."""

    columns: tuple[str, ...]
    other: DataFrame
    to: tuple[str, ...]


Rule = tuple[str, "Column | Unique | Refers"]


def _marked(df: DataFrame, columns: Sequence[str], keys: DataFrame, mark: str, holds: Column) -> DataFrame:
    """``df`` with ``mark``: whether the rule holds. ``keys`` has those that may break it, under names of its own."""
    same = reduce(and_, (F.col(f"`{c}`") == F.col(f"{mark}_{k}") for k, c in enumerate(columns)))
    joined = df.join(broadcast_if_small(keys, "broken-keys"), same, "left")
    return joined.withColumn(mark, F.col(f"{mark}_broken").isNull() | holds).select(*[F.col(f"`{c}`") for c in df.columns], mark)


def _unique(df: DataFrame, rule: Unique, mark: str) -> DataFrame:
    known = reduce(and_, (F.col(f"`{c}`").isNotNull() for c in rule.columns))
    order = F.struct(*[F.col(f"`{c}`") for c in rule.first_by]) if rule.first_by else F.lit(True)
    keys = df.where(known).groupBy(*[F.col(f"`{c}`").alias(f"{mark}_{k}") for k, c in enumerate(rule.columns)])
    keys = keys.agg(F.count(F.lit(1)).alias("n"), F.min(order).alias(f"{mark}_first")).where("n > 1").drop("n").withColumn(f"{mark}_broken", F.lit(True))
    holds = (order == F.col(f"{mark}_first")) if rule.first_by else F.lit(False)
    return _marked(df, rule.columns, keys, mark, holds)


def _refers(df: DataFrame, rule: Refers, mark: str) -> DataFrame:
    known = reduce(and_, (F.col(f"`{c}`").isNotNull() for c in rule.columns))
    names = [f"{mark}_{k}" for k in range(len(rule.columns))]
    mine = df.where(known).select(*[F.col(f"`{c}`").alias(n) for c, n in zip(rule.columns, names)]).distinct()
    there = rule.other.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(rule.to, names)])
    missing = mine.join(there, names, "left_anti").withColumn(f"{mark}_broken", F.lit(True))
    return _marked(df, rule.columns, missing, mark, F.lit(False))


def check_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """:func:`~tidemark.operators.validate.with_reject_reason` whose rules may also be :class:`Unique` or :class:`Refers`.

    The reason is the first rule that a row breaks. A rule across rows looks at all rows, also those that break others.
    """
    plain, marks = [], []
    for number, (name, rule) in enumerate(rules):
        if isinstance(rule, Column):
            plain.append((name, rule))
            continue
        marks.append(f"_rule_{number}")
        df = _unique(df, rule, marks[-1]) if isinstance(rule, Unique) else _refers(df, rule, marks[-1])
        plain.append((name, F.col(marks[-1])))
    return with_reject_reason(df, plain).drop(*marks)
