"""Run-level events (SNK4, INT16): started, registered, completed, one row each, without collecting counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.state import event_rows


def run_event(spark: SparkSession, stage: str, event_type: str, day_id: str, at: Column, run_id: str | None,
              detail: Column | None = None, new_status: Column | None = None) -> DataFrame:
    return event_rows(spark.range(1).select(F.lit(day_id).alias("day_id")), stage, event_type, "pipeline", at,
                      detail=detail, run_id=run_id, new_status=new_status)


def tally(spark: SparkSession, day_id: str, **frames: DataFrame) -> DataFrame:
    """One row: ``day_id`` and the number of rows of each frame, in one aggregation over their union."""
    rows = spark.range(1).select(F.lit("").alias("what"), F.lit(0).cast("long").alias("n"))
    for name, df in frames.items():
        rows = rows.unionByName(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n"))
    return rows.groupBy().agg(*[F.sum(F.when(F.col("what") == k, F.col("n")).otherwise(0)).alias(k) for k in frames]) \
               .withColumn("day_id", F.lit(day_id))


def counted_event(counts: DataFrame, stage: str, event_type: str, at: Column, run_id: str | None,
                  detail: Column | None = None, new_status: Column | None = None) -> DataFrame:
    """An event whose detail or status is made of a ``tally``."""
    return event_rows(counts, stage, event_type, "pipeline", at, detail=detail, run_id=run_id, new_status=new_status)


def text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
