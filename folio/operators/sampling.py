"""Annotation sample and prediction export (SMP1, SNK6)."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.common import KEYS
from folio.schemas import SPLIT_RESULTS

# Fixed value: the seed text that makes the sample of a batch repeatable.
SAMPLE_SEED_PREFIX = "check-sample-"
# Hash buckets used to find the sample cut of a batch without sorting the batch.
HASH_BUCKETS_HEX = 4  # 16 ** 4 = 65536 buckets


def sample_key(day_id: Column, filename: Column) -> Column:
    """Deterministic order of a batch's files: md5 of a seeded text."""
    return F.md5(F.concat(F.lit(SAMPLE_SEED_PREFIX), day_id, F.lit(":"), filename))


def sample_size(n: Column, pct: float) -> Column:
    """k = max(1, round_half_even(n * pct / 100)), in exact integer arithmetic."""
    fr = Fraction(str(pct)).limit_denominator(10 ** 6)
    num = n.cast("bigint") * F.lit(fr.numerator)
    den = F.lit(100 * fr.denominator).cast("bigint")
    rem = num % den
    q = ((num - rem) / den).cast("bigint")
    up = (rem * 2 > den) | ((rem * 2 == den) & (q % 2 == 1))
    return F.greatest(F.lit(1).cast("bigint"), q + up.cast("bigint"))


def annotation_sample(split: DataFrame, pct: float) -> DataFrame:
    """SMP1: per batch the k files with the smallest seeded hash; same sample on rerun.

    Exact bottom-k by one digit of a radix select: one aggregation gathers the distinct files of each (batch,
    hash bucket); a running count over a batch's 65536 buckets at most finds how many files each bucket gives, and
    only the bucket where the cut falls is sorted.  A bucket is 1/65536 of a batch.  Files are read and shuffled once: the
    counts come from the same exchange.
    """
    if not 0 < pct <= 100:
        raise ValueError(f"sample_pct={pct} out of range (0, 100]")
    h = split.select(*KEYS, sample_key(F.col("day_id"), F.col("filename")).alias("_h"))
    h = h.withColumn("_b", F.conv(F.substring("_h", 1, HASH_BUCKETS_HEX), 16, 10).cast("int"))
    # said here, so that both uses of the buckets have the same filter and share an exchange
    buckets = (h.where("day_id IS NOT NULL AND _b IS NOT NULL").groupBy("day_id", "_b").agg(F.collect_set(F.struct(F.col("_h").alias("sample_key"), "filename")).alias("_files"))
               .withColumn("_c", F.size("_files").cast("bigint")))
    batch = Window.partitionBy("day_id")
    upto = batch.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    room = sample_size(F.sum("_c").over(batch), pct) - (F.sum("_c").over(upto) - F.col("_c"))
    cut = buckets.select("day_id", "_b", room.alias("_room")).where("_room > 0")
    j = buckets.join(cut, ["day_id", "_b"])
    taken = F.when(F.col("_c") <= F.col("_room"), F.col("_files")).otherwise(
        F.slice(F.sort_array("_files"), 1, F.least("_c", "_room").cast("int")))
    return j.select("day_id", F.explode(taken).alias("f")).select("day_id", "f.filename", "f.sample_key")


def export_predictions(pending: DataFrame, split: DataFrame) -> DataFrame:
    """SNK6: one JSON record per sampled, not yet annotated file: its latest prediction,
    or a stub with note 'not_yet_processed'."""
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in SPLIT_RESULTS.fields if f.name not in split.columns]
    split = split.select("*", *missing)
    p = split.select(*KEYS, "folder_id", "total_pages", "n_documents", "predicted_starts", "model_used",
                     "fallback_used", "verification_applied", F.coalesce(F.col("needs_review"), F.lit(False))
                     .alias("needs_review"), "boundary_source", "processing_timestamp")
    j = pending.select(*KEYS).join(p, list(KEYS), "left")
    has = F.col("total_pages").isNotNull() | F.col("predicted_starts").isNotNull()
    nulls = {"ignoreNullFields": "false"}  # a record always has all its keys
    full = F.to_json(F.struct("filename", "folder_id", "day_id", "total_pages", "n_documents", "predicted_starts",
                              "model_used", "fallback_used", "verification_applied", "needs_review",
                              "boundary_source", F.col("processing_timestamp").cast("string").alias("processed_at")), nulls)
    stub = F.to_json(F.struct("filename", "day_id", F.lit("not_yet_processed").alias("note"),
                              F.lit(None).cast("array<int>").alias("predicted_starts")), nulls)
    return j.select(*KEYS, has.alias("has_prediction"), F.when(has, full).otherwise(stub).alias("record"))
