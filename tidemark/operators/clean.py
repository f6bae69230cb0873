"""Rating rows from CSV text: arity, type and range checks with counted rejects."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions import parse_float, parse_integer
from tidemark.operators import validate

CORRUPT = "_corrupt_record"

# Columns of a ratings file and the inclusive rating range.
RATING_COLUMNS = ("userId", "movieId", "rating", "timestamp")
RATING_RANGE = (0.5, 5.0)


def _typed(column: str) -> str:
    return f"typed_{column}"


@dataclass(frozen=True)
class CleanResult:
    """Lazy views of one checked input."""

    checked: DataFrame
    columns: tuple[str, ...]

    @property
    def valid(self) -> DataFrame:
        """Typed rows that passed every check."""
        return self.checked.filter(F.col(validate.REASON).isNull()).select(
            *[F.col(_typed(c)).alias(c) for c in self.columns]
        )

    @property
    def rejects(self) -> DataFrame:
        """Rejected rows as they were read, with the reason."""
        return validate.rejected_rows(self.checked).drop(*map(_typed, self.columns))

    @property
    def metrics(self) -> DataFrame:
        return validate.quality_metrics(self.checked)

    @property
    def reasons(self) -> DataFrame:
        return validate.reject_counts(self.checked)

    def write_valid(self, path: str, fmt: str = "parquet") -> dict[str, int]:
        """Write the valid rows, replacing ``path``, and count all rows in the same pass."""
        observation = Observation()
        seen = self.checked.observe(observation, *validate.quality_counters())
        valid = CleanResult(seen, self.columns).valid
        valid.write.mode("overwrite").option("header", True).format(fmt).save(path)
        return observation.get


def clean_ratings(
    rows: DataFrame,
    lo: float = RATING_RANGE[0],
    hi: float = RATING_RANGE[1],
    keep_nan: bool = False,
    columns: tuple[str, ...] = RATING_COLUMNS,
) -> CleanResult:
    """Check text rows (user, item, value, time, all strings, plus ``_corrupt_record``).

    The reason of a reject is the first that applies: ``arity`` (not four
    fields), ``type`` (a field is no number of its kind), ``range``.
    """
    user, item, value, time = columns
    typed = F.struct(
        parse_integer(user).alias(_typed(user)),
        parse_integer(item).alias(_typed(item)),
        parse_float(value).alias(_typed(value)),
        parse_integer(time).alias(_typed(time)),
    )
    rating = F.col(_typed(value))
    in_range = rating.between(lo, hi)
    if keep_nan:
        in_range = in_range | F.isnan(rating)
    all_typed = reduce(and_, (F.col(_typed(c)).isNotNull() for c in columns))
    # `inline` converts each row once; as a projection the conversions would be
    # repeated in every filter on the reason.
    checked = validate.with_reject_reason(
        rows.select("*", F.inline(F.array(typed))),
        [("arity", F.col(CORRUPT).isNull()), ("type", all_typed), ("range", in_range)],
    )
    return CleanResult(checked, tuple(columns))
