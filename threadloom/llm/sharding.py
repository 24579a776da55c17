"""Sharding by fixed virtual slots with a versioned slot-to-shard map.

Records are hashed into `SLOTS` slots by their text, so equal texts share a slot. Bytes are summed
per slot in Spark; only these sums (at most `SLOTS` rows) reach the driver, which packs slots into
shards, largest first. The map is a small versioned table; rebalancing edits the map and moves whole
slots, records are never hashed anew. A text whose copies weigh more than half a shard's share is
hot: its copies are spread over the slots by document id. There are fewer than two hot texts per
shard, so their list is bounded.

Cases: null text is a text of its own with size 1 and crc32 0, and unlike the empty text in hashing;
null ids are spread by a stored row number; repeated rows are placed one by one; an empty table
gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from threadloom.llm.common import long_id, new_folder, stored, whole_row

SLOTS = 4096
# Places in a shard are counted per (shard, bucket), so no task ever holds a whole shard.
BUCKETS = 1024
# Rows of slots; rows of hot texts have no slot, and those of neither state the number of shards.
MAP_SCHEMA = "version int, slot int, shard int, bytes long, hot long, shards int"


@dataclass(frozen=True)
class SlotMap:
    """One version of the map: shard of each slot, bytes of each slot, and the hot texts."""

    version: int
    shards: int
    shard_of: dict[int, int]
    bytes_of: dict[int, int]
    hot: tuple[int, ...] = ()

    def loads(self) -> list[int]:
        sums = [0] * self.shards
        for slot, shard in self.shard_of.items():
            sums[shard] += self.bytes_of.get(slot, 0)
        return sums

    def frame(self, spark: SparkSession) -> DataFrame:
        """Slots and their shards."""
        rows = [(s, self.shard_of[s]) for s in sorted(self.shard_of)]
        return spark.createDataFrame(rows, "slot int, shard int")

    def rows(self) -> list[tuple]:
        """Everything that placing records needs, in the columns of a stored map."""
        return [(self.version, None, None, None, None, self.shards),
                *((self.version, None, None, None, text, None) for text in self.hot),
                *((self.version, s, self.shard_of[s], self.bytes_of.get(s, 0), None, None)
                  for s in sorted(self.shard_of))]


def pack(bytes_of: dict[int, int], shards: int, hot: tuple[int, ...] = ()) -> SlotMap:
    """First version of a map: each slot, heaviest first, goes to the lightest shard."""
    heap = [(0, shard) for shard in range(shards)]
    shard_of = {}
    for slot in sorted(range(SLOTS), key=lambda s: (-bytes_of.get(s, 0), s)):
        load, shard = heapq.heappop(heap)
        shard_of[slot] = shard
        heapq.heappush(heap, (load + bytes_of.get(slot, 0), shard))
    sizes = {slot: bytes_of.get(slot, 0) for slot in range(SLOTS)}
    return SlotMap(1, shards, shard_of, sizes, hot)


def rebalance(current: SlotMap, shards: int, bytes_of: dict[int, int] | None = None) -> SlotMap:
    """Next version of a map: slots move from the fullest shard to the emptiest while that helps.

    Added shards start empty, and slots move into them only; shards beyond `shards` are emptied.
    """
    sizes = dict(current.bytes_of if bytes_of is None else bytes_of)
    shard_of = dict(current.shard_of)
    loads = [0] * shards
    slots: list[list[int]] = [[] for _ in range(shards)]
    homeless = []
    for slot in sorted(shard_of, key=lambda s: (sizes.get(s, 0), s)):
        if shard_of[slot] < shards:
            loads[shard_of[slot]] += sizes.get(slot, 0)
            slots[shard_of[slot]].append(slot)
        else:
            homeless.append(slot)
    for slot in reversed(homeless):
        to = loads.index(min(loads))
        shard_of[slot] = to
        loads[to] += sizes.get(slot, 0)
        slots[to].append(slot)
    open_to = range(current.shards, shards) if shards > current.shards else range(shards)
    while True:
        full, thin = loads.index(max(loads)), min(open_to, key=lambda s: (loads[s], s))
        gap = loads[full] - loads[thin]
        fitting = [s for s in slots[full] if 0 < sizes.get(s, 0) < gap]
        if not fitting:
            return SlotMap(current.version + 1, shards, shard_of, sizes, current.hot)
        move = min(fitting, key=lambda s: (abs(2 * sizes.get(s, 0) - gap), s))
        slots[full].remove(move)
        slots[thin].append(move)
        loads[full] -= sizes[move]
        loads[thin] += sizes[move]
        shard_of[move] = thin


def size_of_text() -> Column:
    return (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size")


def digests(docs: DataFrame) -> DataFrame:
    """What placement needs of each record, stored once so that texts are read once."""
    text = F.col("text").cast("string")
    return stored(
        docs.select(long_id(), text.alias("text")).select(
            "doc_id",
            size_of_text(),
            F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
            F.xxhash64("text").alias("text_key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-digests",
    )


def slot_of(hot: tuple[int, ...], spread: Column) -> Column:
    """The virtual slot of a record; `spread` tells the copies of a hot text apart."""
    by_text = F.pmod(F.xxhash64("text_key"), F.lit(SLOTS)).cast("int")
    if not hot:
        return by_text
    by_record = F.pmod(F.xxhash64("text_key", spread), F.lit(SLOTS)).cast("int")
    return F.when(F.col("text_key").isin(list(hot)), by_record).otherwise(by_text)


def build_map(records: DataFrame, shards: int) -> SlotMap:
    """Sum bytes per slot and pack the slots; the driver gets sums of slots and hot texts only."""
    total = records.agg(F.sum("size")).first()[0] or 0
    hot = tuple(sorted(
        row.text_key
        for row in records.groupBy("text_key").agg(F.sum("size").alias("bytes"))
        .filter(F.col("bytes") > total / (2 * shards)).collect()
    ))
    spread = F.coalesce("doc_id", "row")
    sums = records.groupBy(slot_of(hot, spread).alias("slot")).agg(F.sum("size").alias("bytes"))
    return pack({row.slot: row.bytes for row in sums.collect()}, shards, hot)


def store_map(spark: SparkSession, slot_map: SlotMap, path: str | None = None) -> str:
    """Append this version of the map to its table; earlier versions stay readable."""
    path = path or new_folder(spark, "slot-map")
    spark.createDataFrame(slot_map.rows(), MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def load_map(spark: SparkSession, path: str, shards: int | None = None, version: int | None = None,
             hot: tuple[int, ...] | None = None) -> SlotMap:
    """A stored version of the map, the newest unless named; it is complete in itself.

    A map has `SLOTS` rows a version, one of its own and fewer than two hot texts per shard.
    """
    rows = spark.read.schema(MAP_SCHEMA).parquet(path)
    version = version or rows.agg(F.max("version")).first()[0]
    rows = rows.filter(F.col("version") == version).collect()
    slots = [r for r in rows if r.slot is not None]
    stated = next(r.shards for r in rows if r.shards is not None)
    known = tuple(sorted(r.hot for r in rows if r.hot is not None))
    return SlotMap(version, shards or stated, {r.slot: r.shard for r in slots},
                   {r.slot: r.bytes for r in slots}, known if hot is None else hot)


def placed(records: DataFrame, slot_map: SlotMap) -> DataFrame:
    """Records with their virtual slot and shard; the map has `SLOTS` rows, so it is broadcast."""
    mapped = slot_map.frame(records.sparkSession).select(
        F.col("slot").alias("virtual_slot"), "shard")
    spread = F.coalesce("doc_id", "row")
    return records.withColumn("virtual_slot", slot_of(slot_map.hot, spread)).join(
        F.broadcast(mapped), "virtual_slot")


def with_place(records: DataFrame) -> DataFrame:
    """Gapless place of each record in its shard, counted per bucket and summed over buckets."""
    bucket = F.pmod(F.xxhash64(F.coalesce("doc_id", "row"), F.lit("place")), F.lit(BUCKETS))
    records = records.withColumn("bucket", bucket.cast("int"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (
        records.groupBy("shard", "bucket").count()
        .select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    )
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "row")
    return (
        records.withColumn("n", F.row_number().over(within))
        .join(F.broadcast(offsets), ["shard", "bucket"])
        .withColumn("slot", (F.col("first") + F.col("n") - 1).cast("long"))
    )


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """One row per record: its size, virtual slot, shard and place in the shard."""
    records = digests(docs)
    slot_map = build_map(records, shards)
    path = store_map(docs.sparkSession, slot_map)
    slot_map = load_map(docs.sparkSession, path)
    return with_place(placed(records, slot_map))


def write_shards(docs: DataFrame, slot_map: SlotMap, path: str) -> None:
    """Write whole records into one folder `in_shard=n` per shard, by the same hashing and map, unshuffled.

    Columns of any name come back as they were; `in_shard` is given another name if they hold one.
    """
    folder = "in_shard"
    while folder in docs.columns:
        folder += "_"
    mapped = slot_map.frame(docs.sparkSession).select(
        F.col("slot").alias("virtual_slot"), F.col("shard").alias(folder))
    keyed = docs.select(
        whole_row(docs), F.xxhash64(F.col("text").cast("string")).alias("text_key"),
        F.coalesce(F.col("doc_id").cast("long"), F.monotonically_increasing_id()).alias("spread"))
    (
        keyed.withColumn("virtual_slot", slot_of(slot_map.hot, F.col("spread")))
        .join(F.broadcast(mapped), "virtual_slot").select("row.*", folder)
        .write.partitionBy(folder).parquet(path)
    )


def op1(docs: DataFrame, shards: int = 8) -> DataFrame:
    """The query's columns; sizes of the shards are near equal (law `bytes`)."""
    return shard_documents(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
