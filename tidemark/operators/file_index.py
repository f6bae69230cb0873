"""Which files may hold given keys: range and Bloom filter of the keys of each file.

The index has one row for each file: number of rows, least and greatest value of the first key column, whether that is null somewhere, and
a Bloom filter over all key columns with :data:`BITS_PER_KEY` bits for each row, made from Spark's bitmap aggregates. A
file that is ruled out holds none of the keys; one that is not ruled out need not hold any, so whoever asks looks at the key columns
of the files that are left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import shared_table

BITS_PER_KEY = 10
PROBES = 5
#: Keys that are tested against filters; more of them meet nearly every file, so ranges alone decide then.
MAX_PROBED_KEYS = 1_000_000
#: Bits of one of Spark's bitmaps.
_BITMAP = 32_768


def key_hash(keys: list[str]) -> Column:
    """One number for the key columns; null is a value like any other."""
    # xxhash64 passes over nulls, so a null and its place are hashed as flags.
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys], *[F.col(f"`{k}`").isNull() for k in keys])


def index_files(rows: DataFrame, keys: list[str], file: str = "file") -> DataFrame:
    """``file, n, low, high, nulls, filter`` of rows that carry their file's name; a filter is a list of (bucket, bitmap)."""
    first = F.col(f"`{keys[0]}`")
    hashed = shared_table(rows.select(file, first.alias("first"), key_hash(keys).alias("hash")), "file-keys")
    sizes = hashed.groupBy(file).agg(
        F.count(F.lit(1)).alias("n"), F.min("first").alias("low"), F.max("first").alias("high"), F.bool_or(F.col("first").isNull()).alias("nulls")
    )
    sizes = sizes.withColumn("buckets", F.ceil(F.col("n") * BITS_PER_KEY / _BITMAP))
    bits = F.col("buckets") * _BITMAP
    # Two halves of one hash give all probes.
    low, high = F.col("hash").bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned("hash", 33)
    places = F.array(*[F.pmod(low + high * F.lit(k), bits) for k in range(PROBES)])
    bitmaps = (
        hashed.join(sizes.select(file, "buckets"), file)
        .select(file, F.explode(places).alias("place"))
        .groupBy(file, F.floor(F.col("place") / _BITMAP).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("place") % _BITMAP).alias("bitmap"))
        .groupBy(file)
        .agg(F.collect_list(F.struct("bucket", "bitmap")).alias("filter"))  # some bits for each row of the file
    )
    return sizes.join(bitmaps, file)


def files_that_may_hold(index: DataFrame, wanted: DataFrame, keys: list[str], file: str = "file") -> list[str]:
    """Names of the files of ``index`` that the keys of ``wanted`` are not ruled out of."""
    first = F.col(f"`{keys[0]}`")
    low, high, nulls, n = wanted.agg(F.min(first), F.max(first), F.bool_or(first.isNull()), F.count(F.lit(1))).first()
    if not n:
        return []
    near = F.lit(False) if low is None else (F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low))
    left = index.where(near | (F.col("nulls") & F.lit(bool(nulls))))
    if n > MAX_PROBED_KEYS:
        return sorted(r[0] for r in left.select(file).collect())
    hashes = np.unique(wanted.select(key_hash(keys).alias("hash")).toArrow().column(0).to_numpy())  # MAX_PROBED_KEYS at most
    shared = index.sparkSession.sparkContext.broadcast(hashes)

    # Tasks get this by value, so that workers need not have this package.
    def may_hold(filters: list, buckets: int, hashes: np.ndarray) -> bool:
        bits = np.zeros(buckets * _BITMAP // 8, np.uint8)
        for part in filters:
            at = part["bucket"] * _BITMAP // 8
            bits[at : at + len(part["bitmap"])] = np.frombuffer(part["bitmap"], np.uint8)
        low, high = hashes & 0x7FFFFFFF, (hashes.view(np.uint64) >> np.uint64(33)).astype(np.int64)
        found = np.ones(len(hashes), bool)
        for k in range(PROBES):
            place = (low + high * k) % (buckets * _BITMAP)
            found &= (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        return bool(found.any())

    def probed(batches):
        for batch in batches:
            keep = [may_hold(f, b, shared.value) for f, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_()))], ["file"])

    found = left.select(F.col(file).alias("file"), "filter", "buckets").mapInArrow(probed, "file string")
    return sorted(r[0] for r in found.collect())
