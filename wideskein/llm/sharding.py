"""Sharding through fixed virtual slots.

A record hashes into one of ``SLOTS`` virtual slots. Bytes are summed per slot (at most ``SLOTS`` rows, so
they fit the driver at any corpus size), and a versioned map says which shard holds each slot. The map is a table
beside the shards: :func:`store` adds a version, :func:`stored` reads all of them. Rebalancing edits the newest
version: it moves whole slots, never single records.

Defined cases. A null text has no bytes and a record's size is its UTF-8 bytes plus 8. A record without
doc_id is hashed by its text, so that many of them spread. Repeated rows go to the same slot and are numbered one
after the other. An empty table gives an empty result and a map that deals slots round robin. Other columns are
ignored.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wideskein.llm.common import bucket_count, cut, gapless_position, shared_dir, text_or_empty

SLOTS = 8192
SEED = 17


@dataclass
class SlotMap:
    """Slot to shard, version 1 first; every edit appends a version and keeps the earlier ones."""

    n_shards: int
    versions: list[list[int]] = field(default_factory=list)

    @property
    def current(self) -> list[int]:
        return self.versions[-1]

    @classmethod
    def balanced(cls, slot_bytes: dict[int, int], n_shards: int, slots: int = SLOTS) -> SlotMap:
        """Largest slot first to the shard with the fewest bytes; empty slots round robin."""
        owner = [s % n_shards for s in range(slots)]
        heap = [(0, shard) for shard in range(n_shards)]
        for slot, size in sorted(slot_bytes.items(), key=lambda x: (-x[1], x[0])):
            load, shard = heapq.heappop(heap)
            owner[slot] = shard
            heapq.heappush(heap, (load + size, shard))
        return cls(n_shards, [owner])

    def grow(self, slot_bytes: dict[int, int]) -> SlotMap:
        """One shard more: slots move from the fullest shards to the new one only, until it has its share of bytes."""
        owner, new = list(self.current), self.n_shards
        load = [0] * (new + 1)
        held: list[list[tuple[int, int]]] = [[] for _ in range(new)]
        for slot, shard in enumerate(owner):
            size = slot_bytes.get(slot, 0)
            load[shard] += size
            heapq.heappush(held[shard], (-size, slot))
        share = sum(load) / (new + 1)
        heap = [(-load[s], s) for s in range(new)]
        heapq.heapify(heap)
        while heap and load[new] < share:
            _, shard = heapq.heappop(heap)
            while held[shard]:
                size, slot = heapq.heappop(held[shard])
                if load[new] - size <= share:
                    owner[slot] = new
                    load[new], load[shard] = load[new] - size, load[shard] + size
                    heapq.heappush(heap, (-load[shard], shard))
                    break
        return SlotMap(new + 1, [*self.versions, owner])

    def rebalance(self, slot_bytes: dict[int, int], tolerance: float = 0.01) -> SlotMap:
        """Move slots from the fullest to the emptiest shard until both are within ``tolerance`` of the mean."""
        owner = list(self.current)
        load = [0] * self.n_shards
        held: list[dict[int, int]] = [{} for _ in load]
        for slot, shard in enumerate(owner):
            if size := slot_bytes.get(slot, 0):
                load[shard] += size
                held[shard][slot] = size
        mean = sum(load) / self.n_shards
        for _ in range(len(owner)):
            full, low = max(range(self.n_shards), key=load.__getitem__), min(range(self.n_shards), key=load.__getitem__)
            gap = load[full] - load[low]
            fits = [(size, slot) for slot, size in held[full].items() if size < gap]
            if gap <= tolerance * mean or not fits:
                break
            size, slot = min(fits, key=lambda x: (abs(gap / 2 - x[0]), x[1]))
            del held[full][slot]
            held[low][slot] = size
            owner[slot] = low
            load[full], load[low] = load[full] - size, load[low] + size
        return self if owner == self.current else SlotMap(self.n_shards, [*self.versions, owner])

    def table(self, spark: SparkSession) -> DataFrame:
        """All versions as rows (version, virtual_slot, shard), to be stored beside the shards."""
        rows = [(v + 1, slot, shard) for v, owner in enumerate(self.versions) for slot, shard in enumerate(owner)]
        return spark.createDataFrame(rows, "version int, virtual_slot int, shard int")

    @classmethod
    def load(cls, table: DataFrame) -> SlotMap:
        rows = sorted((r.version, r.virtual_slot, r.shard) for r in table.collect())
        versions: dict[int, list[int]] = {}
        for version, _, shard in rows:
            versions.setdefault(version, []).append(shard)
        return cls(max(versions[max(versions)]) + 1, [versions[v] for v in sorted(versions)])


def slotted(docs: DataFrame, slots: int = SLOTS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot of every record."""
    text = text_or_empty()
    return docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64(text, F.lit(seed))).otherwise(F.xxhash64("doc_id", F.lit(seed))), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_bytes(rows: DataFrame) -> dict[int, int]:
    """Bytes per slot: at most one row per virtual slot reaches the driver."""
    return {r.virtual_slot: r.bytes for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect()}


def assign(rows: DataFrame, slot_map: SlotMap) -> DataFrame:
    """``rows`` of :func:`slotted` with the shard of the map's newest version and a gapless ``slot`` inside the shard."""
    spark = rows.sparkSession
    owner = spark.createDataFrame(list(enumerate(slot_map.current)), "virtual_slot int, shard int")
    placed = rows.join(F.broadcast(owner), "virtual_slot")
    return gapless_position(placed, "shard", ["doc_id", "size", "text_crc32"], "slot", bucket_count(-(-rows.count() // slot_map.n_shards)))


def store(spark: SparkSession, slot_map: SlotMap, path: str) -> None:
    """Add the versions of the map that ``path`` doesn't hold yet, one file each; stored versions are never changed."""
    try:
        held = spark.read.schema("version int").parquet(path).agg(F.max("version")).first()[0] or 0
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        held = 0
    slot_map.table(spark).where(F.col("version") > held).coalesce(1).write.mode("append").parquet(path)


def stored(spark: SparkSession, path: str) -> SlotMap:
    return SlotMap.load(spark.read.parquet(path))


def shard_documents(docs: DataFrame, n_shards: int = 24, path: str | None = None) -> tuple[DataFrame, SlotMap]:
    """Every record with its shard and place in the shard, and the map that decided it, which is read back from where it was stored.

    ``path`` holds the map (a new folder in the shared one by default). A map that is there already goes on to be
    used: with a shard more it grows, else it is rebalanced if the fullest shard is over the mean by 1 % or more.
    """
    spark = docs.sparkSession
    rows = cut(slotted(docs), "shard-rows")
    sizes = slot_bytes(rows)
    if path is None:
        path = f"{shared_dir(spark)}/wideskein/slot-map-{uuid.uuid4().hex}"
        slot_map = SlotMap.balanced(sizes, n_shards)
    else:
        try:
            slot_map = stored(spark, path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            slot_map = SlotMap.balanced(sizes, n_shards)
        while slot_map.n_shards < n_shards:
            slot_map = slot_map.grow(sizes)
        slot_map = slot_map.rebalance(sizes)
    store(spark, slot_map, path)
    slot_map = stored(spark, path)
    return assign(rows, slot_map), slot_map
