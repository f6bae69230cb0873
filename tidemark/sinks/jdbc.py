"""Relational sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed value: JDBC driver class of the default target.
DEFAULT_DRIVER = "com.mysql.cj.jdbc.Driver"


def jdbc_properties(
    user: str,
    password: str,
    driver: str = DEFAULT_DRIVER,
    connections: int = 16,
    batch_size: int = 10_000,
) -> dict[str, str]:
    """Connection properties. ``connections`` bounds how many tasks write at the same time."""
    return {
        "user": user,
        "password": password,
        "driver": driver,
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
    }


def write_jdbc(
    df: DataFrame, table: str, url: str, properties: dict[str, str], mode: str = "append"
) -> None:
    """Export to ``table``. Appending is at least once: a retried task may repeat rows."""
    df.write.mode(mode).jdbc(url, table, properties=properties)
