"""Sharding by fixed virtual slots.

A record's hash puts it into one of thousands of slots for good. Bytes and rows are summed by slot, and a versioned map
says which shard each slot is in. Rebalancing edits the map, moving few slots; records are never hashed anew.
The number of slots is fixed, so the map's size is bounded whatever the table's.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatrix.llm.common import doc_rows
from curatrix.scratch import Scratch

SHARDS = 24
SLOTS = 8192
LAW = "bytes"
MAP_SCHEMA = "version int, vslot int, shard int"


@dataclass(frozen=True)
class SlotMap:
    """Which shard each virtual slot is in; an edit gives the next version."""

    version: int
    shard_of: tuple[int, ...]

    @property
    def shards(self) -> int:
        return max(self.shard_of) + 1

    def loads(self, bytes_of: list[int], shards: int | None = None) -> list[int]:
        sums = [0] * (shards or self.shards)
        for slot, shard in enumerate(self.shard_of):
            sums[shard] += bytes_of[slot]
        return sums


def first_map(bytes_of: list[int], shards: int = SHARDS) -> SlotMap:
    """Slots in order of falling bytes, each to the shard with fewest bytes so far."""
    heap = [(0, 0, s) for s in range(shards)]
    shard_of = [0] * len(bytes_of)
    for slot in sorted(range(len(bytes_of)), key=lambda i: (-bytes_of[i], i)):
        load, slots, shard = heap[0]
        shard_of[slot] = shard
        heapq.heapreplace(heap, (load + bytes_of[slot], slots + 1, shard))
    return SlotMap(1, tuple(shard_of))


def rebalance(old: SlotMap, bytes_of: list[int], shards: int, slack: float = 0.02) -> SlotMap:
    """The next version for `shards` shards (not fewer than before): slots move from the fullest shards to the emptiest until
    no shard is more than `slack` above or below the mean, or no move helps. All other slots stay."""
    if shards < old.shards:
        raise ValueError("shards can't be taken away")
    shard_of, loads = list(old.shard_of), old.loads(bytes_of, shards)
    members: list[list[int]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(shard_of):
        members[shard].append(slot)
    # the mean of the shards that no slot fills alone
    level, rest, left = sum(bytes_of) / shards, sum(bytes_of), shards
    for size in sorted(bytes_of, reverse=True):
        if size <= level or left == 1:
            break
        rest, left = rest - size, left - 1
        level = rest / left
    while True:
        bare = min(range(shards), key=lambda s: (loads[s], s))
        # a shard that one huge record fills may have no slot to give; then the next one does
        for full in sorted((s for s in range(shards) if loads[s] > (1 + slack) * level or loads[bare] < (1 - slack) * level), key=lambda s: (-loads[s], s)):
            gap = loads[full] - loads[bare]
            fit = [i for i in members[full] if 0 < bytes_of[i] < gap and loads[bare] + bytes_of[i] <= (1 + slack) * level]
            if fit:
                break
        else:
            return SlotMap(old.version + 1, tuple(shard_of))
        # rather one that doesn't leave its shard below the mean, which others would have to fill again
        slot = min(fit, key=lambda i: (loads[full] - bytes_of[i] < (1 - slack) * level, abs(gap / 2 - bytes_of[i]), i))
        members[full].remove(slot)
        members[bare].append(slot)
        shard_of[slot] = bare
        loads[full] -= bytes_of[slot]
        loads[bare] += bytes_of[slot]


def save_map(spark: SparkSession, found: SlotMap, path: str) -> None:
    """Add a version to the stored map. A version that is there already is an error: another run stored it first."""
    rows = [(found.version, slot, shard) for slot, shard in enumerate(found.shard_of)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("error").parquet(f"{path}/v{found.version:06d}")


def load_map(spark: SparkSession, path: str, version: int) -> SlotMap:
    rows = spark.read.schema(MAP_SCHEMA).parquet(f"{path}/v{version:06d}").collect()
    shard_of = [0] * len(rows)
    for row in rows:
        shard_of[row.vslot] = row.shard
    return SlotMap(version, tuple(shard_of))


def newest_version(spark: SparkSession, path: str) -> int:
    """The newest version of the stored map that was written whole; 0 if there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(at):
        return 0
    names = [f.getPath() for f in system.listStatus(at) if f.getPath().getName().startswith("v")]
    return max((int(p.getName()[1:]) for p in names if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))), default=0)


def current_map(spark: SparkSession, bytes_of: list[int], shards: int, path: str) -> SlotMap:
    """The map for these bytes: the first version, or the newest one edited, which is stored if the edit moves a slot."""
    version = newest_version(spark, path)
    if not version:
        found = first_map(bytes_of, shards)
    else:
        old = load_map(spark, path, version)
        if len(old.shard_of) != len(bytes_of):
            raise ValueError(f"the stored map has {len(old.shard_of)} slots, not {len(bytes_of)}")
        found = rebalance(old, bytes_of, shards)
        if found.shard_of == old.shard_of:
            return old
    save_map(spark, found, path)
    return found


def _slot(doc_id, text, slots: int):
    """The virtual slot; id and text decide, so copies of a text spread."""
    return F.pmod(F.xxhash64(doc_id, text), F.lit(slots)).cast("int")


def _size(text):
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 8).cast("long")


def _bytes(sizes: DataFrame, slots: int) -> list[int]:
    """Bytes of each slot, of rows with vslot and size; as many rows as slots come to the driver."""
    out = [0] * slots
    for s in sizes.groupBy("vslot").agg(F.sum("size").alias("bytes")).collect():
        out[s.vslot] = s.bytes
    return out


def virtual_slots(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 8), text_crc32 and vslot of each row."""
    rows = doc_rows(docs, "doc_id", "text")
    return rows.select("doc_id", _size(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), _slot("doc_id", "text", slots).alias("vslot"))


def shard(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and vslot for every row of docs(doc_id, text).

    slot counts the rows of a shard from 0 without gaps, in the order in which the input's partitions hold them.
    A null text has no bytes and the checksum of the empty text; a null doc_id is hashed like any other. Repeated rows get the
    same virtual slot and different places. No rows: no rows. map_path: where versions of the map are kept. If one is there,
    the newest is edited for the rows as they are now, and the shards are those of the version that results; without map_path the
    map is new.

    Rows are numbered where they are: a task counts the rows of a partition's part of a shard, and the sums of these counts, a
    row for each partition and shard, say where each part begins. So no slot, shard or group of repeated rows has to fit in one task.
    """
    scratch = Scratch(spark, "sharding")
    # the number of a row holds its partition in the upper bits; written once, it stays as it is
    rows = scratch.keep(virtual_slots(docs, slots).withColumn("number", F.monotonically_increasing_id()), "rows")
    found = current_map(spark, _bytes(rows, slots), shards, map_path or f"{scratch.path}/map")
    of = spark.createDataFrame(list(enumerate(found.shard_of)), "vslot int, shard int")
    placed = rows.join(F.broadcast(of), "vslot").withColumn("part", F.shiftright("number", 33))  # a row for each slot, whose number is fixed
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("number")) - 1
    both = placed.withColumn("place", place).join(starts, ["shard", "part"])
    return both.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", (F.col("start") + F.col("place")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "vslot")


def in_shards(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """The rows of docs with vslot and shard as the last columns; no text is moved.

    All other columns stay as they are; vslot and shard of the input, in any case, are replaced. Nulls, repeated rows, no rows and
    map_path: as in `shard`."""
    scratch = Scratch(spark, "sharding")
    names = [f"c{i}" for i in range(len(docs.columns))]
    doc_id, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    plain = docs.toDF(*names)
    found = current_map(spark, _bytes(plain.select(_size(text).alias("size"), _slot(doc_id, text, slots).alias("vslot")), slots), shards, map_path or f"{scratch.path}/map")
    of = spark.createDataFrame(list(enumerate(found.shard_of)), "vslot int, shard int")
    placed = plain.withColumn("vslot", _slot(doc_id, text, slots)).join(F.broadcast(of), "vslot")  # a row for each slot
    kept = [(n, c) for n, c in zip(names, docs.columns, strict=True) if c.lower() not in ("vslot", "shard")]
    return placed.select(*(n for n, _ in kept), "vslot", "shard").toDF(*(c for _, c in kept), "vslot", "shard")


def rebalanced(spark: SparkSession, docs: DataFrame, map_path: str, version: int, shards: int, slots: int = SLOTS) -> SlotMap:
    """Read a version of the map, edit it for the docs as they are and `shards` shards, and store the next version."""
    found = rebalance(load_map(spark, map_path, version), _bytes(virtual_slots(docs, slots), slots), shards)
    save_map(spark, found, map_path)
    return found
