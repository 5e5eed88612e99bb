"""Sharding over fixed virtual slots.

Every record hashes, by id, text and the number among its copies, to one of a fixed number of virtual
slots; the number never follows the data, so a record keeps its slot for good, and an id that many rows
carry fills no slot. Bytes and rows are summed per slot, and a small
versioned table maps slots to shards. Rebalancing edits that table alone: it moves whole
slots and leaves the other entries, hence the other records, where they are.

Only DataFrame functions touch records. The driver handles the slot table, whose length is
the fixed slot count.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deskmart.llm.common import scratch, stage

SLOTS = 4096
COPIES = 1000  # numbered per step, so that no array of copies grows long


@dataclass(frozen=True)
class SlotMap:
    """Version, number of shards, and the shard of each slot."""

    version: int
    n_shards: int
    shard_of: tuple[int, ...]

    @classmethod
    def balanced(cls, weights: Sequence[int], n_shards: int) -> SlotMap:
        """Heaviest slot first, each to the lightest shard; slots without bytes are dealt in turn."""
        heap = [(0, 0, s) for s in range(n_shards)]
        shard_of = [0] * len(weights)
        for slot in sorted(range(len(weights)), key=lambda i: (-weights[i], i)):
            load, n, shard = heapq.heappop(heap)
            shard_of[slot] = shard
            heapq.heappush(heap, (load + weights[slot], n + 1, shard))
        return cls(1, n_shards, tuple(shard_of))

    def rebalanced(self, weights: Sequence[int], n_shards: int | None = None, tolerance: float = 0.02) -> SlotMap:
        """The next version, for new slot weights or another number of shards, with few slots moved.

        Slots of shards that no longer exist move, then slots leave shards above the mean for the
        lightest shard as long as that lowers the larger of the two loads and these differ by more than ``tolerance`` of the mean.
        """
        n = self.n_shards if n_shards is None else n_shards
        shard_of, load = list(self.shard_of), [0] * n
        homeless = []
        for slot, shard in enumerate(shard_of):
            if shard < n:
                load[shard] += weights[slot]
            else:
                homeless.append(slot)
        for slot in sorted(homeless, key=lambda i: (-weights[i], i)):
            shard_of[slot] = shard = min(range(n), key=lambda s: (load[s], s))
            load[shard] += weights[slot]
        members: list[list[int]] = [[] for _ in range(n)]
        for slot, shard in enumerate(shard_of):
            members[shard].append(slot)
        for _ in range(len(shard_of)):
            high, low = max(range(n), key=lambda s: (load[s], -s)), min(range(n), key=lambda s: (load[s], s))
            gap = load[high] - load[low]
            if gap * n <= tolerance * sum(load):
                break
            fitting = [i for i in members[high] if 0 < weights[i] < gap]
            if not fitting:
                break
            slot = min(fitting, key=lambda i: (abs(2 * weights[i] - gap), i))
            members[high].remove(slot)
            members[low].append(slot)
            shard_of[slot] = low
            load[high] -= weights[slot]
            load[low] += weights[slot]
        return SlotMap(self.version + 1, n, tuple(shard_of))

    def save(self, spark: SparkSession, path: str) -> None:
        """Add this version to the map table at ``path``; earlier versions stay."""
        rows = [(i, s, self.n_shards) for i, s in enumerate(self.shard_of)]
        table = spark.createDataFrame(rows, "vslot int, shard int, n_shards int").coalesce(1)
        table.write.parquet(f"{path}/version={self.version}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int) -> SlotMap:
        rows = spark.read.parquet(f"{path}/version={version}").orderBy("vslot").collect()
        return cls(version, rows[0].n_shards, tuple(r.shard for r in rows))


def slot_of(*key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


def number_copies(records: DataFrame) -> DataFrame:
    """``records`` with ``copy``, from 0 among equal rows; counted first, so copies meet in one task only as a count."""
    counted = records.groupBy(*records.columns).agg(F.count("*").alias("_n"))
    blocks = counted.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES))))
    last = F.least(F.col("_n"), (F.col("_block") + 1) * COPIES) - 1
    return blocks.withColumn("copy", F.explode(F.sequence(F.col("_block") * COPIES, last))).drop("_n", "_block")


def slot_totals(records: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of each slot of ``records(vslot, size)``; at most ``slots`` rows reach the driver."""
    weights, counts = [0] * slots, [0] * slots
    for row in records.groupBy("vslot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        weights[row.vslot], counts[row.vslot] = row.b, row.n
    return weights, counts


def shard_documents(
    docs: DataFrame, n_shards: int = 40, slots: int = SLOTS, overhead: int = 16, map_path: str | None = None
) -> DataFrame:
    """Deal ``docs(doc_id, text)`` into ``n_shards`` shards of nearly equal bytes.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot, map_version``: ``size`` is the
    UTF-8 length plus ``overhead`` (NULL text: none), ``slot`` the place in the shard, gapless from 0, by virtual
    slot and then by doc_id, size and checksum. Rows that agree in all three are alike, so ties
    change nothing. Rows with a NULL or repeated doc_id spread over the virtual slots by their texts, equal rows by their number; an
    empty table gives no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    numbered = number_copies(
        docs.select(docs["doc_id"].alias("doc_id"), (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    )
    vslot = slot_of(F.col("doc_id"), F.col("text_crc32"), F.col("copy"), slots=slots)
    records = stage(numbered.select("doc_id", "size", "text_crc32", vslot.alias("vslot")), "slots")
    weights, counts = slot_totals(records, slots)
    slot_map = SlotMap.balanced(weights, n_shards)
    slot_map.save(spark, map_path or scratch(spark, "slot-map"))
    before, rows = [0] * n_shards, []
    for vslot, shard in enumerate(slot_map.shard_of):
        rows.append((vslot, shard, before[shard]))
        before[shard] += counts[vslot]
    table = F.broadcast(spark.createDataFrame(rows, "vslot int, shard int, first long"))  # `slots` rows, whatever the data
    place = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32"))
    return (
        records.withColumn("_place", place)
        .join(table, "vslot")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("_place") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "vslot",
            F.lit(slot_map.version).alias("map_version"),
        )
    )
