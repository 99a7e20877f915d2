"""Sharding by fixed virtual slots (operator 2), DataFrame functions only.

A record is hashed into one of a fixed number of virtual slots; bytes and rows
are summed per slot; a versioned slot-to-shard map says which shard holds a
slot.  Rebalancing edits the map and moves whole slots: :func:`dealt_map`
makes the first version (slots in turn, before any size is known),
:func:`rebalance` edits it to near equal bytes, :func:`grow` adds one shard
that only receives.  A map has as many rows as there are slots, whatever the
corpus, so it is edited on the driver and broadcast.

Defined cases: a null text has size 1 and the crc of the empty text; the slot
hash takes id, text and the copy's number among equal rows, so rows that share
an id (or have none), equal texts and repeated rows all spread over slots; an
empty table gives no rows; a text of any length is one record in one slot, so a
shard is at least as heavy as its longest text.  Ties: slots of equal bytes are
taken by number, rows of a slot by id (null first), crc, size and copy.  Only
``key`` and ``text`` are read, so other columns' names do not matter.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardsentry.llm.common import materialize

N_SLOTS = 4096
# Copies of a row that one generated range makes at most; more are several ranges.
COPY_RANGE = 65_536
SlotMap = dict[int, int]


def slotted(docs: DataFrame, n_slots: int = N_SLOTS, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, copy and virtual_slot of every document.

    Equal rows are counted where they lie and numbered from the count, so a row
    repeated any number of times never meets in one task."""
    t = F.col(text).cast("string")
    counted = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(t, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(key).cast("long"), t).alias("_hash"),
    ).groupBy("doc_id", "size", "text_crc32", "_hash").agg(F.count("*").alias("_n"))
    ranges = counted.withColumn("_range", F.explode(F.sequence(F.lit(0), F.expr(f"(_n - 1) div {COPY_RANGE}"))))
    first = F.col("_range") * COPY_RANGE
    last = F.least(first + COPY_RANGE, F.col("_n")) - 1
    copies = ranges.repartition("_hash", "_range").withColumn("copy", F.explode(F.sequence(first, last)))
    slot = F.pmod(F.xxhash64("_hash", "copy"), F.lit(n_slots)).cast("long")
    return copies.select("doc_id", "size", "text_crc32", "copy", slot.alias("virtual_slot"))


def slot_sizes(records: DataFrame) -> dict[int, tuple[int, int]]:
    """(bytes, rows) per used slot: at most the number of slots."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    return {r.virtual_slot: (r.b, r.n) for r in sums.collect()}


def dealt_map(n_shards: int, n_slots: int = N_SLOTS) -> SlotMap:
    """First map, before any size is known: slots in turn."""
    return {slot: slot % n_shards for slot in range(n_slots)}


def balanced_map(sizes: dict[int, tuple[int, int]], n_shards: int, n_slots: int = N_SLOTS) -> SlotMap:
    """A map made anew: slots by falling bytes, each to the lightest shard."""
    heap = [(0, s) for s in range(n_shards)]
    out: SlotMap = {}
    for slot in sorted(range(n_slots), key=lambda s: (-sizes.get(s, (0, 0))[0], s)):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + sizes.get(slot, (0, 0))[0], shard))
    return out


def _loads(slot_map: SlotMap, sizes: dict[int, tuple[int, int]], n_shards: int) -> list[int]:
    loads = [0] * n_shards
    for slot, shard in slot_map.items():
        loads[shard] += sizes.get(slot, (0, 0))[0]
    return loads


def rebalance(slot_map: SlotMap, sizes: dict[int, tuple[int, int]], n_shards: int) -> SlotMap:
    """Edited map: while it lowers the heaviest shard, move the slot from the
    heaviest to the lightest shard that best halves their difference."""
    out = dict(slot_map)
    loads = _loads(out, sizes, n_shards)
    own: list[list[int]] = [[] for _ in range(n_shards)]
    for slot, shard in out.items():
        own[shard].append(slot)
    while True:
        high, low = max(range(n_shards), key=loads.__getitem__), min(range(n_shards), key=loads.__getitem__)
        gap = loads[high] - loads[low]
        fits = [s for s in own[high] if 0 < sizes.get(s, (0, 0))[0] < gap]
        if not fits:
            return out
        slot = min(fits, key=lambda s: (abs(gap - 2 * sizes[s][0]), s))
        own[high].remove(slot)
        own[low].append(slot)
        out[slot] = low
        loads[high] -= sizes[slot][0]
        loads[low] += sizes[slot][0]


def grow(slot_map: SlotMap, sizes: dict[int, tuple[int, int]], n_shards: int) -> SlotMap:
    """Edited map with one more shard, which takes slots from the heaviest
    shards until it holds its share; no slot moves between old shards."""
    out = dict(slot_map)
    loads = [*_loads(out, sizes, n_shards), 0]
    share = sum(loads) / (n_shards + 1)
    for slot in sorted(out, key=lambda s: (-sizes.get(s, (0, 0))[0], s)):
        size = sizes.get(slot, (0, 0))[0]
        if size and loads[out[slot]] - size / 2 >= share and loads[-1] + size / 2 <= share:
            loads[out[slot]] -= size
            loads[-1] += size
            out[slot] = n_shards
    return out


def write_map(spark: SparkSession, slot_map: SlotMap, folder: str, version: int) -> None:
    """Store a map as its own version; an existing version is never edited."""
    rows = spark.createDataFrame(sorted(slot_map.items()), "virtual_slot long, shard int")
    rows.coalesce(1).write.mode("error").parquet(f"{folder}/version={version}")


def read_map(spark: SparkSession, folder: str, version: int) -> SlotMap:
    rows = spark.read.parquet(f"{folder}/version={version}").collect()
    return {r.virtual_slot: r.shard for r in rows}


def place(records: DataFrame, slot_map: SlotMap, sizes: dict[int, tuple[int, int]]) -> DataFrame:
    """Add shard and slot, the gapless position inside the shard: rows of the
    shard's earlier virtual slots, then the row's rank in its own."""
    taken: dict[int, int] = {}
    rows = []
    for virtual, shard in sorted(slot_map.items()):
        rows.append((virtual, shard, taken.get(shard, 0)))
        taken[shard] = taken.get(shard, 0) + sizes.get(virtual, (0, 0))[1]
    spark = records.sparkSession
    # One row per virtual slot, a fixed number.
    where = F.broadcast(spark.createDataFrame(rows, "virtual_slot long, shard int, _base long"))
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "copy")) - 1
    return (
        records.withColumn("_rank", rank)
        .join(where, "virtual_slot")
        .withColumn("slot", F.col("_base") + F.col("_rank"))
        .drop("_base", "_rank")
    )


def shard_documents(docs: DataFrame, n_shards: int, folder: str, *, n_slots: int = N_SLOTS, version: int | None = None,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard every document by the map ``version`` of ``folder`` (None: no map
    yet, version 1 deals the slots), edited to near equal bytes and stored as
    the next version, from which the rows are placed."""
    spark = docs.sparkSession
    records = materialize(slotted(docs, n_slots, key=key, text=text), "slotted")
    sizes = slot_sizes(records)
    if version is None:
        version = 1
        write_map(spark, dealt_map(n_shards, n_slots), folder, version)
    write_map(spark, rebalance(read_map(spark, folder, version), sizes, n_shards), folder, version + 1)
    return place(records, read_map(spark, folder, version + 1), sizes)
