"""Numbers from dirty text: a stated grammar, then a cast that yields null instead of failing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGER_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_PATTERN = r"(?i)^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|nan|[+-]?inf(inity)?)\s*$"


def parse_integer(text: Column | str) -> Column:
    """BIGINT, or null when the text is no plain integer or does not fit."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast("bigint"))


def parse_float(text: Column | str) -> Column:
    """DOUBLE, or null. The grammar keeps out ``1d``, ``1f`` and hex floats, which the cast takes."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(FLOAT_PATTERN), text.try_cast("double"))
