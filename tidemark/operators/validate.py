"""Rule-based row validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def with_reject_reason(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add the name of the first rule a row breaks, null for a valid row.

    A rule is (name, condition that must hold); a condition that is null does not hold.
    """
    broken = [F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules]
    return df.withColumn(REASON, F.coalesce(F.lit(None).cast("string"), *broken))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(REASON)


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNotNull())


def quality_counters() -> list[Column]:
    """Aggregates over checked rows; total = valid + skipped."""
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(REASON).isNull()).alias("valid_rows"),
        F.count_if(F.col(REASON).isNotNull()).alias("skipped_rows"),
    ]


def quality_metrics(checked: DataFrame) -> DataFrame:
    """One row of counters."""
    return checked.agg(*quality_counters())


def reject_counts(checked: DataFrame) -> DataFrame:
    """Rejected rows per reason."""
    return rejected_rows(checked).groupBy(REASON).agg(F.count(F.lit(1)).alias("row_count"))
