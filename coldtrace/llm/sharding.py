"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record goes to one of thousands of slots by the hash of its key, for good. A small map sends
slots to shards. Bytes are summed per slot in one map-side combined aggregation; rebalancing edits
the map, slot by slot, and stores it as the next version, so only the rows of edited slots move.
Everything that runs on rows is DataFrame code. The map has one entry per slot, whatever the number
of rows, and is edited on the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOTS = 4096
MAP_SCHEMA = "slot int, shard int"


def slot_of(key: Column, otherwise: Column, slots: int = SLOTS) -> Column:
    """Slot of a key. Rows without a key are spread by `otherwise`, as they may be many."""
    hashed = F.when(key.isNull(), F.xxhash64(otherwise)).otherwise(F.xxhash64(key))
    return F.pmod(hashed, F.lit(slots)).cast("int")


def slot_totals(placed: DataFrame, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows per slot of a table with `vslot` and `size`: two numbers a slot."""
    totals = placed.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    sizes, counts = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    for row in totals.collect():  # at most one row a slot
        sizes[row.vslot], counts[row.vslot] = row.bytes, row.rows
    return sizes, counts


def first_map(shards: int, slots: int = SLOTS) -> np.ndarray:
    """Version 1: slots dealt round robin, before any size is known."""
    return (np.arange(slots) % shards).astype(np.int64)


def rebalance(slot_map: np.ndarray, sizes: np.ndarray, shards: int) -> np.ndarray:
    """Edits a map until no single move of a slot brings two shards closer together.

    Each step moves, from the fullest shard to the emptiest, the slot whose bytes come closest to
    half their difference. With a higher `shards` than before, new shards start empty and fill up.
    """
    edited = slot_map.copy()
    load = np.bincount(edited, weights=sizes, minlength=shards).astype(np.int64)
    while True:
        order = np.argsort(load, kind="stable")
        empty, moved = int(order[0]), False
        for full in order[:0:-1]:
            gap = load[full] - load[empty]
            mine = np.flatnonzero((edited == full) & (sizes > 0) & (sizes < gap))
            if len(mine):
                best = mine[np.argmin(np.abs(2 * sizes[mine] - gap))]
                edited[best] = empty
                load[full] -= sizes[best]
                load[empty] += sizes[best]
                moved = True
                break
        if not moved:
            return edited


def save_map(spark: SparkSession, root: str, version: int, slot_map: np.ndarray) -> None:
    rows = [(slot, int(shard)) for slot, shard in enumerate(slot_map)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{root}/version={version}"
    )


def load_map(spark: SparkSession, root: str, version: int | None = None) -> np.ndarray:
    """A stored version, the newest by default."""
    if version is None:
        version = spark.read.parquet(root).agg(F.max("version")).first()[0]
    rows = spark.read.schema(MAP_SCHEMA).parquet(f"{root}/version={version}").orderBy("slot")
    return np.array([row.shard for row in rows.collect()], np.int64)


def place(placed: DataFrame, slot_map: np.ndarray, counts: np.ndarray, order: list[str]) -> DataFrame:
    """Adds `shard` and `slot`, the row's place in its shard, counted from 0 without gaps.

    A shard holds its virtual slots one after the other. Rows are numbered inside their virtual
    slot only, so the widest sort is one slot of thousands, never a shard.
    """
    base = np.zeros(len(slot_map), np.int64)
    for shard in range(int(slot_map.max()) + 1):
        mine = np.flatnonzero(slot_map == shard)
        base[mine] = np.cumsum(counts[mine]) - counts[mine]
    spark = placed.sparkSession
    rows = [(v, int(s), int(b)) for v, (s, b) in enumerate(zip(slot_map, base))]
    bounded = F.broadcast(spark.createDataFrame(rows, "vslot int, shard int, base long"))
    inside = W.partitionBy("vslot").orderBy(*order)
    return (
        placed.withColumn("at", F.row_number().over(inside) - 1)
        .join(bounded, "vslot")
        .withColumn("slot", F.col("base") + F.col("at"))
        .drop("base", "at")
    )


def shard_documents(
    docs: DataFrame, root: str, shards: int = 24, slots: int = SLOTS
) -> DataFrame:
    """Documents in `shards` shards of near-equal bytes; both map versions are stored under `root`.

    A row's bytes are its text's UTF-8 bytes, none for NULL, plus 8. NULL ids are spread by text,
    repeated rows are placed one by one, an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        slot_of(F.col("doc_id"), F.col("text"), slots).alias("vslot"),
    )
    sizes, counts = slot_totals(rows, slots)
    spark = docs.sparkSession
    save_map(spark, root, 1, first_map(shards, slots))
    save_map(spark, root, 2, rebalance(load_map(spark, root, 1), sizes, shards))
    return place(rows, load_map(spark, root), counts, ["doc_id", "text_crc32", "size"])
