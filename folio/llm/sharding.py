"""Sharding over fixed virtual slots with a versioned slot-to-shard map.

Every record is hashed into one of ``n_slots`` virtual slots; that never changes.  Bytes
and rows are aggregated per slot, and a small table says which shard holds which slot.
Rebalancing edits that table and stores it under the next version; records move only with
their slot.  The law is ``bytes``: sizes of shards near equal.

Records with the same key and text hash alike, so a record repeated often makes its slot too heavy
to place.  A slot that holds more than a 16th of a shard besides its largest record is split: its records are
dealt over sub-slots by their place in the stored records, and sub-slots are rows of the map, with
their ``parent``.

Everything the driver holds is one row per slot (8,192 by default) and sub-slot (at most 32 per shard and one
per split slot), whatever the input.

Defined results: a null text has no bytes; a null key is hashed by the text's checksum;
records with the same key and text share a slot or its sub-slots and are ordered arbitrarily there, so
they are interchangeable; an empty table gives no rows and an even map; extra columns
are not read.
"""

from __future__ import annotations

import bisect
import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from folio.llm.common import keep

N_SLOTS = 8_192
ROW_OVERHEAD = 16
#: A slot of more than this share of a shard's bytes is split.
HEAVY = 1 / 16
MAP_SCHEMA = "version int, slot int, shard int, bytes long, rows long, first_row long, parent int"


def records(docs: DataFrame, n_slots: int = N_SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot): all that placement needs; texts stay behind."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    crc = F.crc32(body)
    slot: Column = F.pmod(F.xxhash64(F.col(key), crc), F.lit(n_slots)).cast("int")
    return docs.select(F.col(key).alias("doc_id"), (F.octet_length(body) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
                       crc.alias("text_crc32"), slot.alias("virtual_slot"))


def slot_sizes(recs: DataFrame) -> dict[int, tuple[int, int, int]]:
    """Bytes, rows and the largest row's bytes by slot: one aggregated row per slot reaches the driver."""
    rows = recs.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.max("size").alias("most")).collect()
    return {r["virtual_slot"]: (r["b"], r["n"], r["most"]) for r in rows}


def split_heavy(recs: DataFrame, sizes: dict[int, tuple[int, int, int]], n_shards: int, n_slots: int = N_SLOTS
                ) -> tuple[DataFrame, dict[int, int]]:
    """``recs`` with the records of heavy slots dealt over sub-slots, and each sub-slot's parent.

    Records are dealt by ``place``, which is stored with them, so every reading deals them alike.
    """
    most = HEAVY * sum(b for b, _, _ in sizes.values()) / n_shards
    parent, rows = {}, []
    for slot, (b, n, largest) in sorted(sizes.items()):
        if b - largest > most:
            parts = min(n, int(2 * b / most) + 1)
            rows.append((slot, n_slots + len(parent), parts))
            parent.update({n_slots + len(parent) + k: slot for k in range(parts)})
    if not rows:
        return recs, parent
    heavy = F.broadcast(recs.sparkSession.createDataFrame(rows, "virtual_slot int, first_sub int, parts int"))
    dealt = F.pmod(F.xxhash64("place"), F.col("parts")).cast("int")
    return (recs.join(heavy, "virtual_slot", "left")
            .withColumn("virtual_slot", F.coalesce(F.col("first_sub") + dealt, "virtual_slot")).drop("first_sub", "parts")), parent


def even_map(n_shards: int, n_slots: int = N_SLOTS) -> dict[int, int]:
    """Version 1: slots dealt out in turn, before any size is known."""
    return {s: s % n_shards for s in range(n_slots)}


def rebalance(placed: dict[int, int], sizes: dict[int, tuple[int, ...]], n_shards: int) -> dict[int, int]:
    """An edited map: slots move one at a time from the fullest to the emptiest shard, the
    one nearest to half their difference each time, until no move brings them closer.
    Shards that are new (no slot yet) are filled the same way."""
    out = dict(placed)
    held: dict[int, list[tuple[int, int]]] = {k: [] for k in range(n_shards)}
    for slot, shard in placed.items():
        if b := sizes.get(slot, (0, 0))[0]:
            held[shard].append((b, slot))
    total = {k: sum(b for b, _ in v) for k, v in held.items()}
    for v in held.values():
        v.sort()
    least, most = [(t, k) for k, t in total.items()], [(-t, k) for k, t in total.items()]
    heapq.heapify(least)
    heapq.heapify(most)
    stuck: set[int] = set()
    while True:
        while most and (-most[0][0] != total[most[0][1]] or most[0][1] in stuck):
            heapq.heappop(most)
        while least and least[0][0] != total[least[0][1]]:
            heapq.heappop(least)
        if not most or not least:
            return out
        full, empty = most[0][1], least[0][1]
        gap = total[full] - total[empty]
        at = bisect.bisect_left(held[full], (gap / 2, -1))
        near = [x for x in held[full][max(0, at - 1):at + 1] if 0 < x[0] < gap]
        if not near:
            stuck.add(full)  # its smallest slot is larger than the difference
            continue
        item = min(near, key=lambda x: abs(x[0] - gap / 2))
        held[full].remove(item)
        bisect.insort(held[empty], item)
        out[item[1]] = empty
        for k, sign in ((full, -1), (empty, 1)):
            total[k] += sign * item[0]
            heapq.heappush(most, (-total[k], k))
            heapq.heappush(least, (total[k], k))


def map_rows(spark: SparkSession, version: int, placed: dict[int, int], sizes: dict[int, tuple[int, ...]],
             parent: dict[int, int] | None = None) -> DataFrame:
    """The map as a table; ``first_row`` is the place of a slot's first record in its shard."""
    rows, seen, parent = [], {}, parent or {}
    for slot in sorted(placed):
        shard, (b, n, *_) = placed[slot], sizes.get(slot, (0, 0))
        rows.append((version, slot, shard, b, n, seen.get(shard, 0), parent.get(slot)))
        seen[shard] = seen.get(shard, 0) + n
    return spark.createDataFrame(rows, MAP_SCHEMA)


def save_map(rows: DataFrame, path: str) -> None:
    """Append a version; earlier ones stay readable."""
    rows.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version, the latest by default."""
    every = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == version)


def place(recs: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Each record's shard and its place there (gapless from 0).  The sort is within a
    virtual slot, never within a shard; the map has one row per slot and is broadcast."""
    inside = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")) - 1
    owner = F.broadcast(slot_map.select(F.col("slot").alias("virtual_slot"), "shard", "first_row"))
    return (recs.withColumn("inside", inside).join(owner, "virtual_slot")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first_row") + F.col("inside")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "virtual_slot"))


def shard(docs: DataFrame, n_shards: int, map_path: str, n_slots: int = N_SLOTS) -> DataFrame:
    """Place all rows of ``docs``: version 1 of the map deals the slots out, the bytes per
    slot are aggregated, and version 2 is the map rebalanced to them."""
    spark = docs.sparkSession
    recs = keep(records(docs, n_slots).withColumn("place", F.monotonically_increasing_id()), "shard-records")
    sizes = slot_sizes(recs)
    first = even_map(n_shards, n_slots)
    save_map(map_rows(spark, 1, first, sizes), map_path)
    recs, parent = split_heavy(recs, sizes, n_shards, n_slots)
    if parent:
        sizes = slot_sizes(recs)
        first |= {sub: first[slot] for sub, slot in parent.items()}
    save_map(map_rows(spark, 2, rebalance(first, sizes, n_shards), sizes, parent), map_path)
    return place(recs, load_map(spark, map_path))
