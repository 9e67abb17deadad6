"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Every record hashes to one of ``slots`` (8,192) virtual slots, for ever.  One aggregation
gives rows and bytes per slot; the slot table has a fixed size, so the driver may hold it.
Version 0 of the map deals the slots round-robin; a rebalance edits it into the next
version by moving slots from heavy shards to light ones until the sizes are near equal.
All versions are written as one Parquet table; adding or removing shards is another edit.
Data moves only with its slot, and a shard's content is known from the map alone.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

SLOTS = 8192
#: A record's size beyond its text, in bytes.
OVERHEAD = 16


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) for every row.

    Size: UTF-8 bytes of the text (null: none) plus 16.  A row without doc_id is placed by
    its text's checksum.  Other columns are ignored.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"))
    key = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text_crc32")))
    return rows.withColumn("virtual_slot", F.pmod(key, F.lit(slots)).cast("int"))


def first_map(slots: int, shards: int) -> list[int]:
    """Version 0: slot i belongs to shard i mod ``shards``."""
    return [s % shards for s in range(slots)]


def rebalance(owners: list[int], weights: list[int], shards: int) -> list[int]:
    """The map's next version: the same slots, sizes near equal.

    Shards are filled by the heaviest slots first, and a slot stays where it is while its
    shard has room below the mean; what does not fit goes, heaviest first, to the lightest
    shard.  Slots of shards that no longer exist move.  Ties: the lower slot or shard.
    """
    mean = sum(weights) / shards
    load, out, loose = [0] * shards, [-1] * len(owners), []
    for slot in sorted(range(len(owners)), key=lambda s: (-weights[s], s)):
        home = owners[slot]
        if home < shards and load[home] + weights[slot] <= mean:
            out[slot], load[home] = home, load[home] + weights[slot]
        else:
            loose.append(slot)
    heap = [(x, s) for s, x in enumerate(load)]
    heapq.heapify(heap)
    for slot in loose:
        x, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (x + weights[slot], shard))
    return out


def slot_table(rows: DataFrame, slots: int = SLOTS) -> list[tuple[int, int]]:
    """(rows, bytes) of each slot: a list of fixed length ``slots``."""
    found = {r[0]: (r[1], r[2]) for r in rows.groupBy("virtual_slot")
             .agg(F.count("*"), F.sum("size")).collect()}
    return [found.get(s, (0, 0)) for s in range(slots)]


def shard_map(rows: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """The written map: (version, virtual_slot, shard, slot_rows, slot_bytes, first_position).

    first_position: where the slot's rows begin among its shard's, in slot order.
    """
    spark = rows.sparkSession
    table = slot_table(rows, slots)
    v0 = first_map(slots, shards)
    v1 = rebalance(v0, [b for _, b in table], shards)
    out = []
    for version, owners in enumerate((v0, v1)):
        filled = [0] * shards
        for s, owner in enumerate(owners):
            out.append((version, s, owner, *table[s], filled[owner]))
            filled[owner] += table[s][0]
    schema = ("version int, virtual_slot int, shard int, slot_rows long, slot_bytes long, "
              "first_position long")
    return materialise(spark.createDataFrame(out, schema), "shard-map")


def shard_documents(docs: DataFrame, shards: int = 40, slots: int = SLOTS) -> DataFrame:
    """Every row with its shard under the map's newest version; law ``bytes``.

    Columns: doc_id, size, text_crc32, law, shard, slot (position in the shard, gapless
    from 0), grown_shard (null: the law is not ``key``), virtual_slot, map_version.
    Equal rows are placed like any other; an empty table gives an empty table.
    """
    rows = sized(docs, slots)
    table = shard_map(rows, shards, slots)
    newest = table.where(F.col("version") == 1).select("virtual_slot", "shard", "first_position",
                                                       F.col("version").alias("map_version"))
    order = Window.partitionBy("virtual_slot").orderBy(F.col("doc_id").asc_nulls_last(), "text_crc32", "size")
    return (rows.withColumn("nth", F.row_number().over(order))
            .join(F.broadcast(newest), "virtual_slot")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first_position") + F.col("nth") - 1).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version"))
