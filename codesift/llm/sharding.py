"""Sharding over fixed virtual slots.

Every record hashes into one of ``N_SLOTS`` virtual slots; the slot of a record never changes.
Bytes per slot are summed, and a small versioned slot-to-shard map (``SlotMap``) assigns whole slots
to shards.  Rebalancing edits the map only: ``grow`` moves slots into new shards and nowhere else.

Law: ``bytes`` - shard sizes are near equal (to within about one slot).

Defined cases: a null text has no bytes (size is the per-row overhead alone); a null id is hashed by
its text; rows repeated in full share a slot; ties inside a slot are numbered by id, size and
checksum, so equal rows get distinct numbers in an arbitrary but gapless order; an empty table gives an
empty result and a map in which the slots are dealt evenly; extra columns of the input are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codesift.llm.staging import staged

N_SLOTS = 4096
ROW_OVERHEAD = 8
#: Sub-cells of a slot: rows are numbered inside (slot, cell), so no task sorts more than 1/65536 of the rows.
N_CELLS = 16


@dataclass(frozen=True)
class SlotMap:
    """Which shard holds which virtual slot.  ``shards[i]`` is the shard of slot i."""

    version: int
    n_shards: int
    shards: tuple[int, ...] = field(repr=False)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The map as a table (vslot, shard, n_shards), the form in which a version is stored."""
        return spark.createDataFrame([(i, s, self.n_shards) for i, s in enumerate(self.shards)], "vslot int, shard int, n_shards int")

    def save(self, spark: SparkSession, path: str) -> SlotMap:
        """Store this version in the folder of maps.  A stored version never changes: saving it again raises."""
        self.to_frame(spark).coalesce(1).write.parquet(f"{path.rstrip('/')}/version={self.version}")
        return self


def stored_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap | None:
    """A stored version of the map, by default the latest; null if there is none.  It has as many rows as slots."""
    try:
        maps = spark.read.schema("vslot int, shard int, n_shards int, version int").parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    rows = sorted(maps.filter(F.col("version") == version).collect())
    return SlotMap(version, rows[0].n_shards, tuple(r.shard for r in rows)) if rows else None


def rebalance(spark: SparkSession, path: str, slot_bytes: dict[int, int], n_shards: int) -> SlotMap:
    """Edit the stored map for more shards: the next version, stored beside the others."""
    return grow(stored_map(spark, path), slot_bytes, n_shards).save(spark, path)


def build_map(slot_bytes: dict[int, int], n_shards: int, n_slots: int = N_SLOTS) -> SlotMap:
    """Heaviest slot first, each to the lightest shard so far.  The input has at most ``n_slots`` entries."""
    if n_shards < 1:
        raise ValueError("at least one shard is needed")
    load = [(0, 0, s) for s in range(n_shards)]
    heapq.heapify(load)
    shards = [0] * n_slots
    for slot in sorted(range(n_slots), key=lambda i: (-slot_bytes.get(i, 0), i)):
        used, count, shard = heapq.heappop(load)
        shards[slot] = shard
        heapq.heappush(load, (used + slot_bytes.get(slot, 0), count + 1, shard))
    return SlotMap(1, n_shards, tuple(shards))


def grow(old: SlotMap, slot_bytes: dict[int, int], n_shards: int) -> SlotMap:
    """The next version of ``old`` with more shards: slots move only from old shards into new ones.

    The heaviest shard gives its largest slot that still fits under the new mean, until every new
    shard has about its share.
    """
    if n_shards < old.n_shards:
        raise ValueError("grow cannot remove shards")
    shards = list(old.shards)
    held: dict[int, list[int]] = {s: [] for s in range(n_shards)}
    for slot in sorted(range(len(shards)), key=lambda i: (slot_bytes.get(i, 0), i)):
        held[shards[slot]].append(slot)
    load = {s: sum(slot_bytes.get(i, 0) for i in held[s]) for s in held}
    mean = sum(load.values()) / n_shards
    for new in range(old.n_shards, n_shards):
        donors = [(-load[s], s) for s in range(old.n_shards)]
        heapq.heapify(donors)
        while donors and load[new] < mean:
            weight, donor = heapq.heappop(donors)
            if not held[donor]:
                continue
            room = mean - load[new]
            fits = [i for i in held[donor] if slot_bytes.get(i, 0) <= room]
            if not fits:
                continue
            slot = fits[-1]
            if slot_bytes.get(slot, 0) == 0:
                continue
            held[donor].remove(slot)
            shards[slot] = new
            load[donor] -= slot_bytes.get(slot, 0)
            load[new] += slot_bytes.get(slot, 0)
            heapq.heappush(donors, (-load[donor], donor))
    return SlotMap(old.version + 1, n_shards, tuple(shards))


def with_slots(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot, cell) per record: one narrow pass over the text."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key = F.when(F.col(id_col).isNull(), F.xxhash64(raw)).otherwise(F.xxhash64(F.col(id_col)))
    # the cell also depends on the text, so that the rows of an id used often are not numbered in one task
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(raw) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.pmod(key, F.lit(n_slots)).cast("int").alias("vslot"),
        F.pmod(F.xxhash64(key, F.crc32(raw)), F.lit(N_CELLS)).cast("int").alias("cell"),
    )


def slot_sizes(slotted: DataFrame) -> dict[int, int]:
    """Bytes per virtual slot; at most ``n_slots`` rows reach the driver."""
    return {r[0]: r[1] for r in slotted.groupBy("vslot").agg(F.sum("size")).collect()}


def shard_of(slot_map: SlotMap, vslot: F.Column) -> F.Column:
    """The map as a lookup on the slot column; the array has ``n_slots`` entries, whatever the data."""
    return F.element_at(F.lit(list(slot_map.shards)), vslot + F.lit(1))


def assign(docs: DataFrame, n_shards: int, slot_map: SlotMap | None = None,
           id_col: str = "doc_id", text_col: str = "text", map_path: str | None = None) -> tuple[DataFrame, SlotMap]:
    """Shard every record.  Returns (doc_id, size, text_crc32, vslot, shard, slot) and the map used.

    ``slot`` numbers the records of a shard gaplessly from 0: rows are numbered inside
    (slot, cell), and each cell starts at the running count of the cells before it in its shard.
    Records are placed by ``slot_map`` if given, else by the latest version stored under ``map_path``; without a stored
    one a map is built, stored there and read back.
    """
    spark = docs.sparkSession
    slotted = staged(with_slots(docs, id_col, text_col), "shard-rows")
    if slot_map is None and map_path is not None:
        if stored_map(spark, map_path) is None:
            build_map(slot_sizes(slotted), n_shards).save(spark, map_path)
        slot_map = stored_map(spark, map_path)
    elif slot_map is None:
        slot_map = build_map(slot_sizes(slotted), n_shards)
    placed = slotted.withColumn("shard", shard_of(slot_map, F.col("vslot")))
    cells = placed.groupBy("shard", "vslot", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("vslot", "cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("vslot", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("vslot", "cell").orderBy("doc_id", "size", "text_crc32")
    numbered = placed.withColumn("nth", F.row_number().over(inside) - 1)
    out = numbered.join(starts, ["vslot", "cell"]).select(
        "doc_id", "size", "text_crc32", "vslot", "shard", (F.col("start") + F.col("nth")).cast("long").alias("slot"))
    return out, slot_map
