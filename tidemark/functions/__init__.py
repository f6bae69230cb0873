"""Column expressions."""

from tidemark.functions.exact import exact_mean, exact_sum, fixed_point
from tidemark.functions.numbers import parse_float, parse_integer
from tidemark.functions.times import as_event_time, epoch_to_timestamp

__all__ = [
    "as_event_time",
    "epoch_to_timestamp",
    "exact_mean",
    "exact_sum",
    "fixed_point",
    "parse_float",
    "parse_integer",
]
