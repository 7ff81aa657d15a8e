"""Sinks: appends, idempotent partition rewrites, lineage cuts, events, run rows (SNK1-7)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.operators.state import touched
from folio.schemas import PIPELINE_EVENTS, RUN_HISTORY, conform
from folio.session import ensure_checkpoint_dir


def append(df: DataFrame, path: str, schema: T.StructType | None = None, partition: str | None = "day_id") -> None:
    """SNK1: append by column name (never by position), partitioned by batch."""
    out = conform(df, schema) if schema is not None else df
    w = out.write.mode("append")
    if partition and partition in out.columns:
        w = w.partitionBy(partition)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition: str = "day_id") -> None:
    """SNK2 (physical side): rewrite only the batches present in ``df`` (dynamic
    partition overwrite), so a rerun replaces its own rows and nothing else."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def rewrite_batches(path: str, targets: DataFrame, update: Callable[[DataFrame], DataFrame], partition: str = "day_id") -> None:
    """SNK2: apply an update to the batches that ``targets`` (day_id, ...) names and rewrite those partitions.

    ``update`` gets the stored rows of those batches and returns their new rows; other
    partitions are neither read (run-time partition pruning) nor written.
    """
    stored = targets.sparkSession.read.parquet(path)
    rows = update(touched(stored, targets))
    overwrite_partitions(rows.select(*stored.columns), path, partition)


def cut_lineage(df: DataFrame, name: str | None = None) -> DataFrame:
    """SNK3: materialise ``df`` in the shared checkpoint folder and read it back.

    Used after every model call so a recomputation (task retry, lost executor,
    second action) never calls the model again.  The result is a Parquet table
    ``<spark.checkpoint.dir>/<name>`` (a fixed path, overwritten by a rerun of the same name), or one
    with a name of its own; ``checkpoint()`` would compute the rows twice.  Never a local checkpoint.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/{name or 'cut-' + uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def append_events(events: DataFrame, path: str) -> bool:
    """SNK4: append event rows; error text is already cut to 2000 chars.  Never raises:
    losing audit rows must not take a pipeline down (returns False instead)."""
    try:
        append(events, path, PIPELINE_EVENTS)
        return True
    except Exception:  # noqa: BLE001
        return False


def run_row(outcome: DataFrame, run_id: str, started_at: Column, completed_at: Column, n_total: Column,
            primary_model: str | None = None, fallback_model: str | None = None) -> DataFrame:
    """SNK5: the run_history row of a batch run, built from the run's outcome
    aggregate (``intake.run_outcome``) without collecting it."""
    dur = (F.unix_timestamp(completed_at) - F.unix_timestamp(started_at)) / 60.0
    out = outcome.select(
        F.lit(run_id).alias("run_id"), F.lit(None).cast("string").alias("job_run_id"),
        started_at.alias("started_at"), completed_at.alias("completed_at"), F.col("run_status").alias("status"),
        n_total.cast("bigint").alias("n_total"),
        F.coalesce(F.col("parsed") + F.col("done"), F.lit(0)).cast("bigint").alias("n_success"),
        F.col("skipped").cast("bigint").alias("n_skipped"), F.col("errored").cast("bigint").alias("n_error"),
        F.lit(primary_model).cast("string").alias("primary_model"),
        F.lit(fallback_model).cast("string").alias("fallback_model"),
        F.round(dur, 2).alias("duration_min"), F.concat(F.lit("day_id="), F.col("day_id")).alias("notes"))
    return conform(out, RUN_HISTORY)


def write_ground_truth(gt: DataFrame, path: str) -> None:
    """SNK7: ground-truth payloads as JSON, one folder per batch."""
    gt.write.mode("append").partitionBy("day_id").json(path)


def write_records(records: DataFrame, path: str, col: str = "record") -> None:
    """SNK6: one JSON text line per exported prediction."""
    records.select(col).write.mode("overwrite").text(path)


def save_state_table(df: DataFrame, table: str, buckets: int, partition: str | None = "day_id",
                     bucket_col: str = "filename", mode: str = "overwrite") -> None:
    """Write a state table bucketed (and sorted) by ``filename`` and partitioned by batch.

    Tables written this way with the same bucket count join and window on
    (day_id, filename) without a shuffle: the processing log and split results
    meet in the file-status view bucket by bucket.  Choose ``buckets`` so a
    bucket of one batch stays around a few hundred MB.
    """
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, bucket_col).sortBy(bucket_col)
    if partition and partition in df.columns:
        w = w.partitionBy(partition)
    w.saveAsTable(table)
