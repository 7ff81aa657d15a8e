"""Incremental intake as a Structured Streaming job.

The reference's intake is an idempotent batch: list the inbox, drop files
already registered or parsed (anti joins), register the rest.  Run as a
stream over the inbox folder, the file source tracks which files were seen
(in the checkpoint), and each micro-batch applies the same idempotent
registration, so a restarted or repeated run never registers a file twice.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.intake import classify_size, path_keys, register
from folio.schemas import PARSED_DOCUMENTS, PROCESSING_LOG
from folio.sources.sinks import append

DAY_FROM_PATH = r"/([^/]+)/[^/]+\.pdf$"
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _table_or_empty(spark: SparkSession, path: str, schema, days: DataFrame) -> DataFrame:
    """The table's rows of the given batches; empty on the first run, when there is no table.  Any other
    failure to read it is raised: going on without it would register every file again."""
    try:
        table = spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return table.join(days, "day_id", "left_semi")


def register_batch(batch: DataFrame, log_path: str, parsed_path: str, run_id: str | None) -> None:
    """One micro-batch: keys and size class from the path, then idempotent registration
    against the batches (``day_id``) that its files belong to."""
    spark = batch.sparkSession
    files = classify_size(path_keys(batch)).withColumn("day_id", F.regexp_extract("path", DAY_FROM_PATH, 1))
    days = files.select("day_id").distinct()
    log = _table_or_empty(spark, log_path, PROCESSING_LOG, days)
    parsed = _table_or_empty(spark, parsed_path, PARSED_DOCUMENTS, days)
    rows = register(files, parsed, log, run_id, F.current_timestamp())
    append(rows, log_path, PROCESSING_LOG)


def start_intake(spark: SparkSession, inbox_root: str, log_path: str, parsed_path: str, checkpoint: str,
                 run_id: str | None = None, available_now: bool = True):
    """Start the intake stream; with ``available_now`` it processes what is there and stops."""
    src = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", "*.pdf")
           .option("recursiveFileLookup", "true").load(inbox_root).select("path", "length"))
    w = (src.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, _epoch: register_batch(df, log_path, parsed_path, run_id)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
