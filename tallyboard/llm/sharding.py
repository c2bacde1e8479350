"""Shards through fixed virtual slots and a versioned slot map (operator 8).

Records are hashed into a fixed, large number of virtual slots, which never change: by id, text and,
where rows are equal in both, the row's number among them, so that repeated rows part. Which shard a
slot belongs to is written in a map of SLOTS rows. The first version deals the slots by
falling bytes, each to the shard with least bytes so far, which makes shards nearly equal
in bytes. Rebalancing edits a copy of the last version: only as many slots move as it takes,
and all others keep their shard. Every version is kept, so that a reader of an older one finds its
records.

Records are written once without their texts. Equal rows are numbered in chunks of `CHUNK` rows, moved by the rows of
the chunks before, so however many there are, no task has to number them all. Bytes are aggregated
per slot before they are shuffled, and the driver holds SLOTS sums. A record's number within its shard is its number within its slot
plus the records of the slots before it, so no shard is ever sorted in one task.

Law: bytes. Sizes of shards are near equal as long as no single record is larger than a shard's
share. Defined results: a null text has no bytes; null ids hash by their text and number; repeated rows
are records of their own and spread over the slots like others; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard.sources.scratch import written

SLOTS = 4096
CHUNK = 1 << 12
OVERHEAD = 16
MAP = T.StructType([T.StructField("version", T.IntegerType(), False), T.StructField("vslot", T.IntegerType(), False), T.StructField("shard", T.IntegerType(), False)])


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def slotted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """One row per row of `docs`, written: id, size, text_crc32 and vslot, its virtual slot."""
    text = F.col(text_col)
    base = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            record_size(text).alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
        )
    )
    chunk = F.shiftright("row", CHUNK.bit_length() - 1)
    equal = base.groupBy("id", "h").count().where("count > 1").select(F.col("id").alias("like_id"), F.col("h").alias("like_h"))
    marked = base.join(equal, F.col("id").eqNullSafe(F.col("like_id")) & (F.col("h") == F.col("like_h")), "left").withColumn("chunk", chunk)
    repeated = marked.where("like_h is not null")
    before = Window.partitionBy("id", "h").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = repeated.groupBy("id", "h", "chunk").count().select(
        F.col("id").alias("off_id"), F.col("h").alias("off_h"), F.col("chunk").alias("off_chunk"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    here = F.col("id").eqNullSafe(F.col("off_id")) & (F.col("h") == F.col("off_h")) & (F.col("chunk") == F.col("off_chunk"))
    number = F.row_number().over(Window.partitionBy("id", "h", "chunk").orderBy("row")) - 1
    numbered = repeated.withColumn("number", number).join(offsets, here).withColumn("number", F.col("number") + F.col("before"))
    single = marked.where("like_h is null").withColumn("number", F.lit(0).cast("long"))
    vslot = F.pmod(F.xxhash64("id", "h", "number"), F.lit(slots)).cast("int").alias("vslot")
    columns = ["id", "size", "text_crc32", vslot]
    return written(single.select(*columns).unionByName(numbered.select(*columns)))


def slot_bytes(records: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """Bytes per virtual slot of what `slotted` gives; at most `slots` rows reach the driver."""
    out = np.zeros(slots, dtype=np.int64)
    for row in records.groupBy("vslot").agg(F.sum("size").alias("size")).collect():
        out[row["vslot"]] = row["size"]
    return out


def first_map(size: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every slot: slots by falling bytes, each to the lightest shard."""
    shard_of = np.zeros(len(size), dtype=np.int64)
    heap = [(0, 0, k) for k in range(shards)]
    for slot in np.argsort(-size, kind="stable").tolist():
        load, held, k = heap[0]
        shard_of[slot] = k
        heapq.heapreplace(heap, (load + int(size[slot]), held + 1, k))
    return shard_of


def rebalance(shard_of: np.ndarray, size: np.ndarray, shards: int, tolerance: float = 0.02) -> np.ndarray:
    """An edited map: slots of shards that are gone go to the lightest, then single slots to the lightest shard from the heaviest that has one to give.

    A slot moves only if it is smaller than what the two shards differ by. It ends when that is `tolerance` of the mean at most, or when no slot moves.
    """
    out = shard_of.copy()
    load = np.bincount(out[out < shards], weights=size[out < shards], minlength=shards)[:shards]
    for slot in sorted(np.flatnonzero(out >= shards).tolist(), key=lambda s: (-size[s], s)):
        out[slot] = k = int(np.argmin(load))
        load[k] += size[slot]
    while True:
        light = int(np.argmin(load))
        for heavy in np.argsort(-load, kind="stable").tolist():
            gap = load[heavy] - load[light]
            if gap <= tolerance * load.mean():
                return out
            own = np.flatnonzero(out == heavy)
            own = own[(size[own] > 0) & (size[own] < gap)]
            if len(own):
                slot = own[np.argmin(np.abs(size[own] - gap / 2))]
                out[slot] = light
                load[heavy] -= size[slot]
                load[light] += size[slot]
                break
        else:
            return out


def map_table(spark: SparkSession, versions: list[np.ndarray]) -> DataFrame:
    """All versions of the map, from 1, as rows."""
    rows = [(v + 1, slot, int(shard)) for v, shards in enumerate(versions) for slot, shard in enumerate(shards.tolist())]
    return spark.createDataFrame(rows, MAP)


def assign(records: DataFrame, slot_map: DataFrame, version: int, id_col: str = "doc_id") -> DataFrame:
    """One row per row of `records` (see `slotted`): id, size, text_crc32, shard, slot (its number in the shard, from 0), vslot and map_version."""
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    places = (
        slot_map.where(F.col("version") == version)
        .join(records.groupBy("vslot").count(), "vslot")
        .select("vslot", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    )
    number = F.row_number().over(Window.partitionBy("vslot").orderBy("id", "text_crc32", "size"))
    # At most a row for each virtual slot.
    placed = records.withColumn("number", number).join(F.broadcast(places), "vslot")
    slot = (F.col("before") + F.col("number") - 1).cast("long").alias("slot")
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", slot, "vslot", F.lit(version).alias("map_version"))


def moved(records: DataFrame, slot_map: DataFrame, version: int, name: str) -> DataFrame:
    """`records`, or what `assign` gives, with the shard of a version of the map as another column."""
    shards = slot_map.where(F.col("version") == version).select("vslot", F.col("shard").alias(name))
    return records.join(F.broadcast(shards), "vslot")
