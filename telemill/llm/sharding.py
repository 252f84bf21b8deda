"""Shards from fixed virtual slots and a versioned slot-to-shard map.

Rows are hashed into a fixed number of slots, bytes are summed per slot, and a map
of one row per slot says which shard holds it. Rebalancing edits the map, never the
hash: a new version moves the slots that even out the bytes, and with them only
their rows. The map has ``slots`` rows at any input size, so it is the one thing
handled on the driver.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOTS = 4096
#: Rows of a slot that are numbered together.
NUMBERED = 50_000
MAP_SCHEMA = "version long, virtual_slot long, shard int, slot_bytes long"


def record_slot(slots: int = SLOTS):
    """Virtual slot of a row: a hash of ``doc_id``, or of the text where the id is null."""
    return F.pmod(
        F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("text"), "text")).otherwise(
            F.xxhash64(F.lit("slot"), F.col("doc_id").cast("string"))
        ),
        F.lit(slots),
    )


def digests(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32 (null text: null) and virtual slot."""
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        record_slot(slots).alias("virtual_slot"),
    )


def _sizes(table: DataFrame, slots: int) -> list[int]:
    """Bytes by slot; ``slots`` rows at most come to the driver."""
    out = [0] * slots
    for slot, size in table.select("virtual_slot", "slot_bytes").toPandas().itertuples(index=False):
        out[int(slot)] = int(size)
    return out


def first_map(spark: SparkSession, slots: int = SLOTS, shards: int = 16) -> DataFrame:
    """Version 0: the slots dealt out in turn, before anything is known of their bytes."""
    rows = [(0, s, s % shards, 0) for s in range(slots)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["version", "virtual_slot", "shard", "slot_bytes"]), MAP_SCHEMA)


def rebalance(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version of a map: slots moved until the bytes of the shards are even.

    Full shards give slots to empty ones, each time the largest slot that still
    lowers the fuller of the two, then pairs of slots are swapped as long as that
    brings the fullest and the emptiest shard closer. ``shards`` may be more or
    fewer than before; slots of a shard that goes are moved first.
    """
    old = slot_map.toPandas().sort_values("virtual_slot")
    sizes_of = _sizes(sizes, len(old))
    home = [int(x) for x in old["shard"]]
    held: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in enumerate(home):
        if shard < shards:
            held[shard].add(slot)
    load = [sum(sizes_of[s] for s in own) for own in held]
    lost = sorted((s for s, shard in enumerate(home) if shard >= shards), key=lambda s: (-sizes_of[s], s))
    heap = [(n, shard) for shard, n in enumerate(load)]
    heapq.heapify(heap)
    for slot in lost:
        n, shard = heapq.heappop(heap)
        held[shard].add(slot)
        load[shard] += sizes_of[slot]
        heapq.heappush(heap, (load[shard], shard))
    for _ in range(4 * len(home)):
        high = max(range(shards), key=lambda i: (load[i], -i))
        low = min(range(shards), key=lambda i: (load[i], i))
        gap = load[high] - load[low]
        moves = [s for s in held[high] if 0 < sizes_of[s] < gap]
        # a move or swap of half the gap would even the two out
        best = min(((abs(2 * sizes_of[s] - gap), s, -1) for s in moves), default=None)
        if best is None or best[0] > gap // 8:
            back = sorted((sizes_of[s], s) for s in held[low])
            for s in held[high]:
                want = sizes_of[s] - gap // 2
                i = _nearest(back, want)
                if i is not None and 0 < sizes_of[s] - back[i][0] < gap:
                    found = (abs(2 * (sizes_of[s] - back[i][0]) - gap), s, back[i][1])
                    best = found if best is None or found < best else best
        if best is None:
            break
        _, out, back_slot = best
        for slot, a, b in ((out, high, low), (back_slot, low, high)):
            if slot >= 0:
                held[a].remove(slot)
                held[b].add(slot)
                load[a] -= sizes_of[slot]
                load[b] += sizes_of[slot]
    shard_of = {slot: shard for shard, own in enumerate(held) for slot in own}
    version = int(old["version"].max()) + 1
    rows = [(version, s, shard_of[s], sizes_of[s]) for s in range(len(home))]
    spark = slot_map.sparkSession
    return spark.createDataFrame(pd.DataFrame(rows, columns=list(old.columns)), MAP_SCHEMA)


def _nearest(ordered: list[tuple[int, int]], want: int) -> int | None:
    import bisect

    i = bisect.bisect_left(ordered, (want, -1))
    near = [j for j in (i - 1, i) if 0 <= j < len(ordered)]
    return min(near, key=lambda j: abs(ordered[j][0] - want), default=None)


def write_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to a stored map; older versions stay and a repeated write replaces its own."""
    slot_map.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of a stored map, the newest by default."""
    kept = spark.read.parquet(path).select("version", "virtual_slot", "shard", "slot_bytes")
    version = kept.agg(F.max("version")).first()[0] if version is None else version
    return kept.filter(F.col("version") == version).select(
        F.col("version").cast("long").alias("version"), "virtual_slot", "shard", "slot_bytes"
    )


def moved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Slots whose shard differs between two versions: virtual_slot, from_shard, to_shard, slot_bytes."""
    a = old.select("virtual_slot", F.col("shard").alias("from_shard"))
    b = new.select("virtual_slot", F.col("shard").alias("to_shard"), "slot_bytes")
    return a.join(b, "virtual_slot").filter("from_shard <> to_shard")


def balanced_map(docs: DataFrame, shards: int = 16, slots: int = SLOTS, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A map fitted to the bytes of ``docs``, and bytes and rows of every slot.

    With ``path`` the map's versions are stored there, and a stored map is taken up
    and edited instead of a new one.
    """
    spark = docs.sparkSession
    stats = digests(docs, slots).groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"), F.count(F.lit(1)).alias("slot_rows"))
    # one read of the texts: ``slots`` rows, held as a local table from here on
    stats = spark.createDataFrame(stats.toPandas(), "virtual_slot long, slot_bytes long, slot_rows long")
    old = read_map(spark, path) if path is not None and _stored(spark, path) else first_map(spark, slots, shards)
    new = rebalance(old, stats, shards)
    if path is not None:
        write_map(old, path)
        write_map(new, path)
    return new, stats


def assign(docs: DataFrame, slot_map: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, text, size, virtual_slot, map_version and shard of every row, moving no row.

    ``slot_map`` has ``slots`` rows, so it may be broadcast.
    """
    rows = docs.select(
        "doc_id", "text", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        record_slot(slots).alias("virtual_slot"),
    )
    held = slot_map.select("virtual_slot", F.col("version").alias("map_version"), "shard")
    return rows.join(F.broadcast(held), "virtual_slot").select("doc_id", "text", "size", "virtual_slot", "map_version", "shard")


def shard_documents(docs: DataFrame, shards: int = 16, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """Put documents into shards of near equal bytes.

    Returns doc_id, size, text_crc32, virtual_slot, map_version, shard, slot. ``slot``
    counts the rows of a shard without gaps from 0. ``path`` is that of
    ``balanced_map``. Null ids are hashed by text, null texts have size 1, rows
    repeated in full get neighbouring slots, and no rows give no rows. A slot is never
    split, so one row larger than a shard's share keeps its shard that much larger.
    Columns other than doc_id and text are ignored.
    """
    slot_map, stats = balanced_map(docs, shards, slots, path)
    rows = digests(docs, slots)
    counts = stats.toPandas()["slot_rows"]
    parts = max(1, math.ceil(int(counts.max()) / NUMBERED)) if len(counts) else 1
    # rows of a slot are numbered in parts, each by its own sort; parts follow one another
    part = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(parts))
    placed = rows.withColumn("_part", part)
    inside = W.partitionBy("virtual_slot", "_part").orderBy("doc_id", "text_crc32", "size")
    if parts == 1:
        at = stats.withColumn("_part", F.lit(0).cast("long"))
    else:
        at = placed.groupBy("virtual_slot", "_part").agg(F.count(F.lit(1)).alias("slot_rows"))
    before = W.partitionBy("shard").orderBy("virtual_slot", "_part").rowsBetween(W.unboundedPreceding, -1)
    starts = at.join(slot_map.select("virtual_slot", "shard", "version"), "virtual_slot").select(
        "virtual_slot", "_part", "shard", F.col("version").alias("map_version"),
        F.coalesce(F.sum("slot_rows").over(before), F.lit(0)).alias("_start"),
    )
    numbered = placed.withColumn("_at", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["virtual_slot", "_part"]).select(
        "doc_id", "size", "text_crc32", "virtual_slot", "map_version", "shard",
        (F.col("_start") + F.col("_at")).alias("slot"),
    )


def _stored(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path).schema  # noqa: B018
        return True
    except AnalysisException:
        return False
