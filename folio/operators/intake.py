"""File intake: keys from paths, size classes, registration, parse queue, run outcomes (INT1-16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.common import KEYS, count_if
from folio.operators.state import event_rows
from folio.schemas import PROCESSING_LOG, conform

# Size limits, parse chunk size, retry limit, messages.
MB = 1024 * 1024
MAX_FILE_SIZE_MB = 100
LARGE_FILE_THRESHOLD_MB = 74
PARSE_CHUNK_SIZE = 100
MAX_RETRIES = 2
OVERSIZED_MESSAGE = "File exceeds 100MB limit"
NULL_PAGES_DETAIL = "n_pages NULL: ai_parse_document returned no positioned elements"
STEM_RE = r"([^/]+)\.pdf$"
FOLDER_RE = r"^([A-Za-z0-9]+)_"
# Hash buckets over which a batch's files are numbered (three hex digits of a name's md5).
NUMBER_BUCKETS_HEX = 3
#: Bytes of files that one parsing task takes, about.
BIN_BYTES = 512 * MB


def _number_bucket() -> Column:
    return F.conv(F.substring(F.md5("filename"), 1, NUMBER_BUCKETS_HEX), 16, 10).cast("int")


def path_keys(df: DataFrame, path: str = "path") -> DataFrame:
    """INT1: filename = stem of '*.pdf', folder_id = leading alphanumerics before '_' ('' if none)."""
    fn = F.regexp_extract(F.col(path), STEM_RE, 1)
    return df.withColumn("filename", fn).withColumn("folder_id", F.regexp_extract(fn, FOLDER_RE, 1))


def size_category(length: Column) -> Column:
    return (F.when(length > MAX_FILE_SIZE_MB * MB, "oversized")
            .when(length > LARGE_FILE_THRESHOLD_MB * MB, "large").otherwise("standard"))


def classify_size(df: DataFrame, length: str = "length") -> DataFrame:
    """INT2: size in MB (2 decimals, display) and the size class, decided once on the
    raw byte count (registration and parse queue then agree)."""
    return (df.withColumn("file_size_mb", F.round(F.col(length) / MB, 2))
            .withColumn("size_category", size_category(F.col(length))))


def size_class_counts(df: DataFrame) -> DataFrame:
    """INT3: files per size class (one aggregation)."""
    return df.groupBy("size_category").agg(F.count(F.lit(1)).alias("n_files"))


def register(inbox: DataFrame, parsed: DataFrame, log: DataFrame, run_id: str | None, at: Column) -> DataFrame:
    """INT4: processing_log rows for files neither parsed nor registered yet in their batch:
    'skipped' with a message when oversized, else 'pending'."""
    new = (inbox.join(parsed.select(*KEYS).distinct(), list(KEYS), "left_anti")
           .join(log.select(*KEYS).distinct(), list(KEYS), "left_anti"))
    over = F.col("size_category") == "oversized"
    rows = new.select(
        "day_id", "filename", "folder_id", "file_size_mb",
        F.when(over, F.lit("skipped")).otherwise(F.lit("pending")).alias("status"),
        F.when(over, F.lit(OVERSIZED_MESSAGE)).alias("error_message"),
        F.lit(0).alias("retry_count"), at.alias("created_at"), F.lit(run_id).alias("run_id"))
    return conform(rows, PROCESSING_LOG)


def parse_queue(inbox: DataFrame, parsed: DataFrame) -> DataFrame:
    """INT7: files still to parse; up to 74 MB in parallel chunks of 100, 74-100 MB one by one.

    Files of a batch and queue are numbered from 1 by (hash bucket, filename), whatever their number: the files per
    bucket are counted, a running count over the 4,096 buckets gives each bucket's first number, and a task
    only ranks the files of one bucket.
    """
    todo = inbox.where(F.col("length") <= MAX_FILE_SIZE_MB * MB).join(
        parsed.select(*KEYS).distinct(), list(KEYS), "left_anti")
    parallel = F.col("length") <= LARGE_FILE_THRESHOLD_MB * MB
    t = todo.withColumn("queue", F.when(parallel, F.lit("parallel")).otherwise(F.lit("sequential"))).withColumn("_b", _number_bucket())
    per = ["day_id", "queue"]
    before = Window.partitionBy(*per).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    first = (t.groupBy(*per, "_b").agg(F.count(F.lit(1)).alias("_n"))
             .select(*per, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    n = F.col("_first") + F.row_number().over(Window.partitionBy(*per, "_b").orderBy("filename"))
    return t.join(first, [*per, "_b"]).select(
        *todo.columns, "queue", F.when(F.col("queue") == "parallel", F.ceil(n / PARSE_CHUNK_SIZE)).cast("int").alias("chunk"),
        F.when(F.col("queue") == "sequential", n).cast("int").alias("sequence"))


def byte_bins(files: DataFrame, bin_bytes: int = BIN_BYTES) -> DataFrame:
    """INT7: ``files`` with the number from 0 of the bin (task) that parses each; a batch's bins have nearly equal bytes.

    A bin is a stretch of the running sum of bytes by (hash bucket, filename), so it is off the batch's mean by one
    file at most.  As in ``parse_queue`` a task only sums the files of one bucket.
    """
    t = files.withColumn("_b", _number_bucket())
    before = Window.partitionBy("day_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    first = (t.groupBy("day_id", "_b").agg(F.sum("length").alias("_n"))
             .select("day_id", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
                     F.sum("_n").over(Window.partitionBy("day_id")).alias("_total"))
             .withColumn("_bins", F.greatest(F.lit(1), F.expr(f"(_total + {bin_bytes - 1}) div {bin_bytes}")))
             .withColumn("_width", F.greatest(F.lit(1), F.expr("(_total + _bins - 1) div _bins"))))
    inside = Window.partitionBy("day_id", "_b").orderBy("filename", "length").rowsBetween(Window.unboundedPreceding, -1)
    summed = t.withColumn("_inside", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    # the last bytes' files may be empty ones, beyond the last bin's start
    number = F.least(F.expr("(_first + _inside) div _width"), F.col("_bins") - 1)
    return summed.join(first, ["day_id", "_b"]).select(*files.columns, number.cast("int").alias("bin"))


def flag_null_pages(parsed: DataFrame, at: Column, run_id: str | None = None) -> DataFrame:
    """INT6: a needs_review event per parsed file without a page count."""
    return event_rows(parsed.where(F.col("n_pages").isNull()), "parse", "needs_review", "pipeline", at,
                      detail=F.lit(NULL_PAGES_DETAIL), run_id=run_id)


def _moves(log: DataFrame, root: str, rules: list[tuple[Column, str, str]]) -> DataFrame:
    """One scan of the log: per file the moves whose condition holds (condition, target, reason)."""
    said = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(dst).alias("to"), F.lit(why).alias("reason"))) for c, dst, why in rules]))
    moves = log.select(*KEYS, F.explode(said).alias("m")).distinct()
    path = lambda vol: F.concat(F.lit(f"{root}/"), vol, F.lit("/"), F.col("day_id"), F.lit("/"), F.col("filename"), F.lit(".pdf"))
    return moves.select(*KEYS, path(F.lit("inbox")).alias("src"), path(F.col("m.to")).alias("dst"), F.col("m.reason").alias("reason"))


def _poison() -> Column:
    return (F.col("status") == "error") & (F.col("error_stage") == "parsing") & (F.col("retry_count") >= MAX_RETRIES)


QUARANTINE_REASON = f"parse failed after {MAX_RETRIES} retries"


def quarantine_plan(log: DataFrame, root: str = "") -> DataFrame:
    """INT9: repeat parse failures to move out of the inbox."""
    return _moves(log, root, [(_poison(), "quarantine", QUARANTINE_REASON)])


def disposition_plan(log: DataFrame, root: str = "") -> DataFrame:
    """INT12: file moves as a table (src, dst, reason): oversized, quarantined, delivered
    packages to archive.  The copies themselves are done outside Spark."""
    split = (F.col("status") == "done") & F.col("sftp_delivery_status").isin("pending", "delivered")
    return _moves(log, root, [(F.col("status") == "skipped", "oversized", "oversized"),
                              (_poison(), "quarantine", QUARANTINE_REASON), (split, "archive", "split")])


def reconcile_events(log: DataFrame, at: Column, run_id: str | None = None) -> DataFrame:
    """INT10 (events): one error event per file stranded in 'parsing'."""
    stuck = log.where(F.col("status") == "parsing").select(*KEYS).distinct()
    return event_rows(stuck, "parse", "error", "pipeline", at, run_id=run_id, old_status=F.lit("parsing"),
                      new_status=F.lit("error"), error_message=F.lit("stranded in parsing at end of run"))


def run_outcome(log: DataFrame, stage: str = "parse") -> DataFrame:
    """INT11: per batch counts and the run status.

    parse: failed when errors and nothing parsed, partial_failure when both, else
    success.  split: success without errors, else partial_failure.
    """
    st = F.col("status")
    agg = log.groupBy("day_id").agg(
        F.count(F.lit(1)).alias("total"), count_if(st == "parsed").alias("parsed"),
        count_if(st == "done").alias("done"), count_if(st == "skipped").alias("skipped"),
        count_if(st == "error").alias("errored"))
    e, p = F.col("errored"), F.col("parsed")
    if stage == "parse":
        out = F.when((e > 0) & (p > 0), "partial_failure").when((e > 0) & (p == 0), "failed").otherwise("success")
    else:
        out = F.when(e == 0, "success").otherwise("partial_failure")
    return agg.withColumn("run_status", out)


def batch_outcome(counts: DataFrame) -> DataFrame:
    """INT16: the early-exit code of each stage for a batch, NULL when the stage has work.

    Expects per-batch counts: n_inbox, n_to_parse, n_oversized_new (parse);
    n_to_split (split); n_split_results, n_validation, n_unannotated (export);
    n_pending, n_routable (delivery).
    """
    c = F.col
    return counts.select(
        "day_id",
        F.when(c("n_inbox") == 0, "NO_FILES")
         .when((c("n_to_parse") == 0) & (c("n_oversized_new") == 0), "ALL_ALREADY_PARSED").alias("parse_outcome"),
        F.when(c("n_to_split") == 0, "NO_FILES_TO_SPLIT").alias("split_outcome"),
        F.when(c("n_split_results") == 0, "NO_SPLIT_RESULTS").when(c("n_validation") == 0, "NO_FILES_IN_VALIDATION")
         .when(c("n_unannotated") == 0, "ALL_ANNOTATED").alias("export_outcome"),
        F.when(c("n_pending") == 0, "NO_FILES_PENDING").when(c("n_routable") == 0, "ALL_DEFERRED")
         .alias("delivery_outcome"))
