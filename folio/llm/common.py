"""Helpers shared by the text operators: reading, lineage cuts, fixed-size hash bitmaps."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.session import ensure_checkpoint_dir
from folio.session import ship as ship_package

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WHITE = " \t\n\x0b\x0c\r"
#: Positions per row of Spark's bitmap aggregate (4,096 bytes each).
BUCKET_BITS = 32_768


#: Bytes of rows that go to a Python worker at once.  Texts are wide: Spark's default of 10,000 rows is 30 MB and more of
#: them, held by the JVM, the worker's Arrow buffers and its strings at the same time.
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, and bound what they get at once unless the session says how much."""
    ship_package(spark)
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def tidy(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``run`` over a task's batches; memory that it has freed goes back to the system when the task ends.

    Workers are used again by later tasks and stages.  What one of them held at its peak would otherwise stay with it,
    in Arrow's pool and in the allocator, beside the executor's own memory.
    """
    @functools.wraps(run)
    def tidied(parts):
        try:
            yield from run(parts)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)

    return tidied


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: later steps start
    from the files, so a lost executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


def sha256_hex(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def hash_bitmap(keys: DataFrame, key: str, bits: int) -> np.ndarray:
    """A bitmap of ``bits`` positions (a power of two) with one bit per value of the
    long column ``key``, at the value's low bits.

    Its size is fixed by ``bits`` whatever the number of keys, so it may be collected
    and broadcast.  ``may_contain`` then says "certainly not" or "perhaps".
    """
    if bits & (bits - 1) or bits < BUCKET_BITS:
        raise ValueError("bits must be a power of two, 32,768 at least")
    at = F.col(key).bitwiseAND(F.lit(bits - 1))
    rows = (keys.where(F.col(key).isNotNull()).select(at.alias("at"))
            .groupBy(F.floor(F.col("at") / BUCKET_BITS).cast("int").alias("bucket"))
            .agg(F.bitmap_construct_agg((F.col("at") % BUCKET_BITS)).alias("bits")).collect())
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in rows:
        out[r["bucket"] * BUCKET_BITS // 8:(r["bucket"] + 1) * BUCKET_BITS // 8] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def may_contain(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys.astype(np.int64) & np.int64(len(bitmap) * 8 - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def row_hash() -> Column:
    return F.xxhash64("doc_id", "text_hash")


def mark_perhaps(rows: DataFrame, row_key: Column, keys: DataFrame, key: Column, bits: int, name: str) -> DataFrame:
    """``rows`` with the boolean ``name``: false if the long ``row_key`` is certainly not among the ``key`` of ``keys``.

    The bitmap is a table of ``bits`` / 32,768 rows of 4 KB, whatever the number of keys, and is joined by
    broadcast.  DataFrame operations only.
    """
    place = lambda k: k.bitwiseAND(F.lit(bits - 1))
    marks = (keys.where(key.isNotNull()).select(place(key).alias("__at"))
             .groupBy(F.floor(F.col("__at") / BUCKET_BITS).alias("__bucket"))
             .agg(F.bitmap_construct_agg(F.col("__at") % BUCKET_BITS).alias("__marks")))
    at = rows.withColumn("__at", place(row_key)).withColumn("__bucket", F.floor(F.col("__at") / BUCKET_BITS))
    byte = F.conv(F.hex(F.substring("__marks", F.floor(F.col("__at") % BUCKET_BITS / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    is_set = byte.bitwiseAND(F.expr("shiftleft(1L, CAST(__at % 8 AS INT))")) != 0
    return (at.join(F.broadcast(marks), "__bucket", "left").withColumn(name, F.coalesce(is_set, F.lit(False)))
            .drop("__at", "__bucket", "__marks"))


def keep_rows(docs: DataFrame, verdicts: DataFrame, bits: int = 1 << 24) -> DataFrame:
    """The rows of ``docs`` that ``verdicts`` (doc_id, text_hash, stays: one row per row of ``docs``) lets stay; of
    rows with the same id and text at most one.

    Rows to which nothing happens are not shuffled: a bitmap of fixed size (2 MB) of the rows that go or
    repeat is broadcast, and only rows that it may hold are joined with the verdicts.  DataFrame
    operations only.
    """
    odd = keep(verdicts.groupBy("doc_id", "text_hash").agg(F.max("stays").alias("stays"), F.count("*").alias("n"))
               .where(~F.col("stays") | (F.col("n") > 1)), "odd-rows")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"))
    rows = mark_perhaps(rows, row_hash(), odd, row_hash(), bits, "odd")
    sure = rows.where(~F.col("odd")).select("row")
    known = odd.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "stays")
    rest = (rows.where("odd").select("row", "doc_id", "text_hash")
            .join(known, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left"))
    passed = rest.where("stays IS NULL").select("row")
    one = rest.where("stays").groupBy("id", "hash").agg(F.first("row").alias("row")).select("row")
    return sure.unionByName(passed).unionByName(one).select("row.*")


__all__ = ["ASCII_UPPER", "WHITE", "hash_bitmap", "keep", "keep_rows", "lower_ascii", "mark_perhaps", "may_contain",
           "row_hash", "scratch", "sha256_hex", "ship",
           "table", "text_hash", "tidy"]
