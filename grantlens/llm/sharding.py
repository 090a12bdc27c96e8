"""Sharding by fixed virtual slots (native).

Records hash into SLOTS virtual slots, bytes are summed by slot, and a stored, versioned map gives each slot its shard. A
version is SLOTS rows at any data size. grow() edits a map for one more shard, rebalance() for uneven bytes; both move
whole slots only. An edit reads the version that it starts from and appends the next; versions are never changed, and an
edit that moves nothing appends none. The map is the table in the folder that grantlens.sharding.map names in the session,
or in slot-map in the shared folder; one run writes it at a time.

Defined results for odd input: a null text has no bytes and checksum 0; a null id hashes as the text 'null';
repeated rows are numbered apart; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prefix_sums, shared_dir, table_at

SLOTS = 4096
#: The stored map: a version's rows name the version that it was edited from, and by what change.
MAP = "version int, parent int, shards int, change string, vslot int, shard int"
MAP_FOLDER = "grantlens.sharding.map"
#: Rows that one numbering bucket is meant to hold.
BUCKET_ROWS = 4096


def grow(owner: list[int], shards: int) -> list[int]:
    """The map for shards + 1: the new shard takes its fair share of slots, one after the other, from whichever shard has most."""
    owner = list(owner)
    held: dict[int, list[int]] = {}
    for slot, shard in enumerate(owner):
        held.setdefault(shard, []).append(slot)
    heap = [(-len(v), k) for k, v in held.items()]
    heapq.heapify(heap)
    for _ in range(len(owner) // (shards + 1)):
        n, k = heapq.heappop(heap)
        owner[held[k].pop()] = shards
        heapq.heappush(heap, (n + 1, k))
    return owner


def slot_map(shards: int, slots: int = SLOTS) -> list[int]:
    """The first map for so many shards: grown from one shard, so shard counts alone decide it."""
    owner = [0] * slots
    for n in range(1, shards):
        owner = grow(owner, n)
    return owner


def rebalance(owner: list[int], slot_bytes: dict[int, int], shards: int, tolerance: float = 0.02) -> list[int]:
    """The map after moving slots from the fullest to the emptiest shard until bytes are within tolerance or no move helps."""
    owner = list(owner)
    load = [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(owner):
        load[shard] += slot_bytes.get(slot, 0)
        held[shard].append((slot_bytes.get(slot, 0), slot))
    mean = sum(load) / shards
    for _ in range(len(owner)):
        hi, lo = max(range(shards), key=lambda k: (load[k], -k)), min(range(shards), key=lambda k: (load[k], k))
        gap = load[hi] - load[lo]
        fit = [x for x in held[hi] if 0 < x[0] < gap]
        if gap <= tolerance * mean or not fit:
            break
        best = min(fit, key=lambda x: (abs(gap / 2 - x[0]), x[1]))
        held[hi].remove(best)
        held[lo].append(best)
        load[hi] -= best[0]
        load[lo] += best[0]
        owner[best[1]] = lo
    return owner


class SlotMap:
    """The stored map in a folder. Of a version only its SLOTS rows reach the driver."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def versions(self) -> DataFrame | None:
        return table_at(self.spark, self.folder, MAP)

    def last(self, shards: int, changes: list[str]) -> tuple[int, list[int]] | None:
        """The latest version, and its slots' shards, that one of the changes made for so many shards."""
        rows = self.versions()
        if rows is None:
            return None
        rows = rows.filter((F.col("shards") == shards) & F.col("change").isin(changes))
        version = rows.agg(F.max("version")).first()[0]
        if version is None:
            return None
        return version, [r["shard"] for r in rows.filter(F.col("version") == version).orderBy("vslot").collect()]

    def append(self, shards: int, change: str, parent: int | None, owner: list[int]) -> tuple[int, list[int]]:
        rows = self.versions()
        version = 1 + ((rows.agg(F.max("version")).first()[0] or 0) if rows is not None else 0)
        made = self.spark.createDataFrame([(version, parent, shards, change, slot, shard) for slot, shard in enumerate(owner)], MAP)
        made.coalesce(1).write.mode("append").parquet(self.folder)
        return version, owner

    def first(self, shards: int) -> tuple[int, list[int]]:
        """The map that the number of shards alone decides."""
        return self.last(shards, ["first"]) or self.append(shards, "first", None, slot_map(shards))

    def grown(self, shards: int) -> tuple[int, list[int]]:
        """The first map, edited for one more shard."""
        found = self.last(shards + 1, ["grown"])
        if found is None:
            version, owner = self.first(shards)
            found = self.append(shards + 1, "grown", version, grow(owner, shards))
        return found

    def rebalanced(self, shards: int, slot_bytes: dict[int, int]) -> tuple[int, list[int]]:
        """The latest map for so many shards, edited for these bytes."""
        version, owner = self.last(shards, ["first", "rebalanced"]) or self.first(shards)
        even = rebalance(owner, slot_bytes, shards)
        return (version, owner) if even == owner else self.append(shards, "rebalanced", version, even)


def records(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the virtual slot; the slot comes from the id alone."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").alias("h"),
        F.conv(F.substring(digest, 9, 8), 16, 10).cast("long").alias("h2"),
    ).withColumn("vslot", F.expr(f"cast(h % {SLOTS} as int)"))


def slot_bytes(rows: DataFrame) -> DataFrame:
    """Bytes and rows by virtual slot: at most SLOTS rows."""
    return rows.groupBy("vslot").agg(F.sum("size").alias("vslot_bytes"), F.count("*").alias("vslot_rows"))


def sharded(docs: DataFrame, shards: int = 24, folder: str | None = None) -> DataFrame:
    """Every row of docs with its shard, its place there, its shard after growing by one, and its shard after rebalancing by bytes.

    The law that holds is `key`: an id and the number of shards decide the shard, and one more shard takes rows only
    into itself. rebalanced_shard is what the latest version of the map, edited for these bytes, gives: it depends on what
    earlier runs stored. folder: of the map.
    """
    spark = docs.sparkSession
    rows = records(docs)
    held = slot_bytes(rows)
    by_slot = {r["vslot"]: (r["vslot_bytes"], r["vslot_rows"]) for r in held.collect()}  # at most SLOTS rows
    slots = SlotMap(spark, folder or spark.conf.get(MAP_FOLDER, None) or f"{shared_dir(spark)}/slot-map")
    chosen = {slots.first(shards)[0]: "shard", slots.grown(shards)[0]: "grown_shard"}
    even = slots.rebalanced(shards, {k: v[0] for k, v in by_slot.items()})[0]
    stored = slots.versions()
    at = lambda version: F.max(F.when(F.col("version") == version, F.col("shard")))
    owners = stored.groupBy("vslot").agg(*[at(v).alias(c) for v, c in chosen.items()], at(even).alias("rebalanced_shard"))
    parts = max(1, -(-max((v[1] for v in by_slot.values()), default=0) // BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.expr(f"vslot * {parts}L + (h2 + text_crc32) % {parts}L"))
    rows = rows.join(F.broadcast(owners), "vslot")  # SLOTS rows
    rows = prefix_sums(rows.withColumn("one", F.lit(1)), ["shard"], "bucket", [F.col("doc_id"), F.col("text_crc32"), F.col("size")], F.col("one"), "slot")
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard", "vslot", "rebalanced_shard")
