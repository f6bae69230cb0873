"""Event times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamps count microseconds in 64 bits.
MAX_EPOCH_SECONDS = (2**63 - 1) // 1_000_000


def epoch_to_timestamp(seconds: Column | str) -> Column:
    """Timestamp of an epoch second, independent of the session zone; null beyond the type's range.

    A round trip through a formatted string would lose the repeated hour when
    clocks go back, so the number is converted directly.
    """
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    in_range = seconds.between(-MAX_EPOCH_SECONDS, MAX_EPOCH_SECONDS)
    return F.when(in_range, F.timestamp_seconds(seconds))


def as_event_time(ts: Column | str) -> Column:
    """A zoned timestamp, which watermarks need; zone-less input is read in the session zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts.cast("timestamp")
