"""Intermediate tables and checkpoints in the folder that all executors share.

The cluster names that folder in ``spark.checkpoint.dir``. A table written there
survives the loss of any executor, which cached blocks do not.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or on a local master without it a folder in the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return f"{spark.conf.get('spark.sql.warehouse.dir', 'spark-warehouse').rstrip('/')}/_shared"
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def run_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def shared_table(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later jobs start from files, of the session's codec by default."""
    spark = df.sparkSession
    path = run_dir(spark, label)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, label: str, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` as a shared table, marked for broadcast only if its measured size allows it.

    Beyond ``max_bytes`` there is no hint: the join shuffles, and Spark splits the
    partitions of hot keys at run time.
    """
    stored = shared_table(df, label)
    row_bytes = F.octet_length(F.to_json(F.struct("*")))
    measured = stored.agg(F.coalesce(F.sum(row_bytes), F.lit(0))).first()[0]
    return F.broadcast(stored) if measured <= max_bytes else stored
