"""Shards by fixed virtual slots and a versioned slot map.

A record's ``doc_id`` hashes to one of a fixed number of slots and never leaves it.  Which shard holds a
slot is written in a small table of versions; to rebalance is to add a version in which some slots
have moved.  The map has one row a slot and version, so its size has nothing to do with the data.

A slot can't be divided between shards.  Where one holds many records and a good part of a shard, as when an id fills a
third of the table, its records are hashed to slots by the row instead.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from noteloom.llm.scratch import written

SLOTS = 1 << 14
SHARDS = 24
OVERHEAD = 8
CROWDED = 0.02  # of the mean shard's bytes; records of a slot with more are hashed by row
MAP = "version int, virtual_slot int, shard int, slot_bytes bigint"


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, virtual_slot, row)``: bytes of the UTF-8 text plus eight; null texts count none.

    ``row`` numbers the rows as they are read; write the result before it is used twice."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("bigint"),
        (F.octet_length(data) + F.lit(OVERHEAD)).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(slots)).cast("int").alias("virtual_slot"),
        F.monotonically_increasing_id().alias("row"),
    )


def uncrowded(records: DataFrame, shards: int, slots: int = SLOTS, crowded: float = CROWDED) -> DataFrame:
    """``records`` with those of crowded slots in slots of their own rows.

    Slots of more than one record that hold more than ``crowded`` of a shard's mean are crowded: at most ``shards`` / ``crowded``.
    """
    loads = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    mean = loads.agg(F.sum("bytes")).scalar() / shards
    full = loads.filter((F.col("n") > 1) & (F.col("bytes") > mean * crowded)).select(F.col("virtual_slot").alias("full"))
    by_row = F.pmod(F.xxhash64("doc_id", "row"), F.lit(slots)).cast("int")
    marked = records.join(F.broadcast(full), F.col("virtual_slot") == F.col("full"), "left")
    return marked.withColumn("virtual_slot", F.when(F.col("full").isNotNull(), by_row).otherwise(F.col("virtual_slot"))).drop("full")


def slot_bytes(records: DataFrame) -> dict[int, int]:
    """Bytes of each slot that has records.  At most one number a slot comes to the driver."""
    return {r[0]: r[1] for r in records.groupBy("virtual_slot").agg(F.sum("size")).collect()}


def even(slots: int, shards: int) -> list[int]:
    """The first version: slots dealt out in turn."""
    return [slot % shards for slot in range(slots)]


def rebalanced(owner: list[int], loads: dict[int, int], shards: int) -> list[int]:
    """The next version: slots leave shards above the mean, largest first, for the shard with least.

    A shard lets go of its small slots last, and of none that it has room for, so little moves.
    """
    target = sum(loads.values()) / shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(owner):
        held[shard].append((loads.get(slot, 0), slot))
    total, loose = [0] * shards, []
    for shard, own in enumerate(held):
        for size, slot in sorted(own, reverse=True):
            if total[shard] + size <= target:
                total[shard] += size
            else:
                loose.append((size, slot))
    room = [(total[shard], shard) for shard in range(shards)]
    heapq.heapify(room)
    after = list(owner)
    for size, slot in sorted(loose, reverse=True):
        least, shard = heapq.heappop(room)
        after[slot] = shard
        heapq.heappush(room, (least + size, shard))
    return after


def slot_map(spark: SparkSession, versions: list[list[int]], loads: dict[int, int]) -> DataFrame:
    """The stored map: all versions of which shard has which slot, from 0 on."""
    rows = [(v, slot, shard, loads.get(slot, 0)) for v, owner in enumerate(versions) for slot, shard in enumerate(owner)]
    return written(spark.createDataFrame(rows, MAP).coalesce(1), "slot-map")


def shard_records(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot)`` of every row of ``(doc_id, text)``.

    The law is ``bytes``: the second version of the map evens out the bytes of the shards, as far as
    whole slots allow.  ``slot`` is the place of a record in its shard, gapless from 0, ordered by virtual slot,
    then ``doc_id``; rows that repeat a ``doc_id`` share a virtual slot and get places of their own, and a null
    ``doc_id`` has a slot like any other, unless the slot is crowded: then its rows are dealt out.  Null and empty texts count
    eight bytes, long ones all of theirs.  An empty table gives no rows.  Columns beside the two are ignored.

    The map of one row a slot is broadcast; places are numbered within a virtual slot, of which
    there are thousands, and start where the slots before it in its shard end.
    """
    records = written(uncrowded(written(sized(docs, slots), "sized"), shards, slots), "slotted")
    loads = slot_bytes(records)
    first = even(slots, shards)
    stored = slot_map(docs.sparkSession, [first, rebalanced(first, loads, shards)], loads)
    latest = stored.filter("version = 1").select("virtual_slot", "shard")
    counts = records.groupBy("virtual_slot").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.join(F.broadcast(latest), "virtual_slot").withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    places = placed.select("virtual_slot", "shard", "start")
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "row")
    return (
        records.withColumn("place", F.row_number().over(within))
        .join(F.broadcast(places), "virtual_slot")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("start") + F.col("place") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
        )
    )
