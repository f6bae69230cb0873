"""Sharding by fixed virtual slots and a versioned map from slots to shards.

A record's key alone decides its slot, one of some thousands. Bytes and rows are added up for each slot, and a
map from slots to shards is edited until the shards' bytes are as equal as moves of single slots can make
them. Every map is stored under its version; a record moves only if its slot does. A position without
gaps follows from the rows in the slots before it in the shard and its rank in its slot, so no task
ever orders a whole shard.

Defined cases: a null text has no bytes; null keys share one slot; equal keys are ordered by size and checksum;
an empty table gives an empty one, with the first map stored; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.workspace import run_dir, shared_table

SLOTS = 4096


def slot_of(key: str, slots: int = SLOTS) -> Column:
    """The virtual slot of a key; it never changes with the data or the number of shards."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(slots)).cast("int")


def edited(shard_of: np.ndarray, weight: np.ndarray, shards: int) -> np.ndarray:
    """A map in which no move of a slot from the fullest to the emptiest shard, or swap between them, evens them further.

    ``shard_of`` is the map to edit; slots of shards that are no longer there are dealt out first.
    """
    shard_of = np.where(shard_of < shards, shard_of, np.arange(len(shard_of)) % shards)
    load = np.bincount(shard_of, weights=weight, minlength=shards)
    while True:
        high, low = int(load.argmax()), int(load.argmin())
        gap = load[high] - load[low]
        own = np.flatnonzero((shard_of == high) & (weight > 0))
        others = np.flatnonzero(shard_of == low)
        others = others[np.argsort(weight[others], kind="stable")]
        # A move is a swap with nothing.
        given = np.concatenate([[0.0], weight[others]])
        near = np.searchsorted(given, weight[own] - gap / 2).clip(0, len(given) - 1)
        place = np.concatenate([near, np.maximum(near - 1, 0)])
        slots = np.concatenate([own, own])
        moved = weight[slots] - given[place]
        useful = np.flatnonzero((moved > 0) & (moved < gap))
        if not len(useful):
            return shard_of
        best = useful[np.abs(moved[useful] - gap / 2).argmin()]
        shard_of[slots[best]] = low
        if place[best]:
            shard_of[others[place[best] - 1]] = high
        load[high] -= moved[best]
        load[low] += moved[best]


class SlotMaps:
    """The versions of the map from slots to shards, one folder of small files each."""

    def __init__(self, spark: SparkSession, folder: str, slots: int = SLOTS):
        self.spark, self.folder, self.slots, self.latest = spark, folder, slots, 0

    def store(self, shard_of: np.ndarray, shards: int) -> int:
        self.latest += 1
        rows = [(slot, int(shard)) for slot, shard in enumerate(shard_of)]
        frame = self.spark.createDataFrame(rows, "virtual_slot int, shard int").withColumn("shards", F.lit(shards))
        frame.coalesce(1).write.parquet(f"{self.folder}/version={self.latest}")
        return self.latest

    def load(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/version={version}")

    def array(self, version: int) -> np.ndarray:
        """One version as an array; its length is the fixed number of slots."""
        rows = self.load(version).select("virtual_slot", "shard").collect()
        shard_of = np.zeros(self.slots, np.int64)
        for slot, shard in rows:
            shard_of[slot] = shard
        return shard_of

    def rebalance(self, slot_weights: DataFrame, shards: int) -> int:
        """Edit the latest map for ``virtual_slot, bytes`` rows and a number of shards; the new version."""
        weight = np.zeros(self.slots)
        for slot, size in slot_weights.select("virtual_slot", "bytes").collect():  # at most one row for each slot
            weight[slot] = size
        return self.store(edited(self.array(self.latest), weight, shards), shards)


def shard_by_bytes(df: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """Every row with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` (its place in the shard) and ``virtual_slot``.

    ``shard`` follows the map's newest version, which makes the shards' bytes nearly equal.
    """
    spark = df.sparkSession
    value = F.coalesce(F.col(text), F.lit(""))
    rows = shared_table(
        df.select(F.col(key).alias("key"), (F.octet_length(value) + 1).cast("bigint").alias("size"), F.crc32(value).alias("crc")).withColumn("virtual_slot", slot_of("key", slots)),
        "slots",
    )
    maps = SlotMaps(spark, folder or run_dir(spark, "slot-maps"), slots)
    maps.store(np.arange(slots) % shards, shards)
    totals = shared_table(rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")), "slot-totals")
    version = maps.rebalance(totals, shards)
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        maps.load(version)
        .select("virtual_slot", "shard")
        .join(totals, "virtual_slot")
        .select("virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    )
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("key", "size", "crc"))
    return (
        rows.withColumn("rank", rank)
        .join(F.broadcast(placed), "virtual_slot")  # at most one row for each slot
        .select(
            F.col("key").alias(key),
            "size",
            F.col("crc").alias("text_crc32"),
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("base") + F.col("rank") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
            F.lit(version).alias("map_version"),
        )
    )
