"""The intake stage as one job: inbox scan -> registration -> parse -> log transitions.

Mirrors the reference's parse run with the operators of ``operators.intake`` and
``operators.state``.  The document parser is a pluggable callable
``(pdf_bytes) -> parsed JSON text`` (failures become data: the file is marked 'error' at
stage 'parsing').  Files are dealt into bins of nearly equal bytes, one per task; only their
paths are shuffled, and a task reads its files' bytes one by one.
Every result is a DataFrame; the caller appends / rewrites the state tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.common import KEYS
from folio.operators import intake as IN
from folio.operators import run_events as RE
from folio.operators import state as ST
from folio.operators.signals import n_pages_expr
from folio.schemas import PARSED_DOCUMENTS, PROCESSING_LOG, conform
from folio.sources.sinks import cut_lineage

Parser = Callable[[bytes], str]
Reader = Callable[[str], bytes]
#: Seconds before a large file is tried again (fixed value of the job).
RETRY_DELAY = 60.0
_PARSE_OUT = T.StructType([T.StructField("day_id", T.StringType()), T.StructField("filename", T.StringType()),
                           T.StructField("parsed_content", T.StringType()), T.StructField("parse_error", T.StringType()),
                           T.StructField("failures", T.ArrayType(T.StringType()))])


def read_bytes(path: str) -> bytes:
    """A file's bytes, read inside a task (local, HDFS and object-store paths)."""
    from pyarrow import fs
    scheme, colon, rest = path.partition(":")
    if colon and scheme == "file":
        path = "/" + rest.lstrip("/")
    store, inner = fs.FileSystem.from_uri(path)
    with store.open_input_stream(inner) as f:
        return f.read()


def run_parser(files: DataFrame, parser: Parser, *, read: Reader = read_bytes, tries: int = 1,
               large_tries: int = 1 + IN.MAX_RETRIES, delay: float = RETRY_DELAY) -> DataFrame:
    """Parse ``files`` (day_id, filename, path, queue, bin): (day_id, filename, parsed_content, parse_error, failures).

    One task per bin; a file's bytes are read in the task and held while it is parsed.  A file is tried ``tries`` times,
    one of the sequential queue ``large_tries`` times, ``delay`` seconds after each failure.  ``failures`` are the
    messages of the failed tries in order; ``parse_error`` is the last one where no try succeeded.
    """
    def attempt(path: str, most: int) -> tuple[str | None, list[str]]:
        import time
        failures: list[str] = []
        while True:
            try:
                return parser(read(path)), failures
            except Exception as ex:  # noqa: BLE001 - failures are data here
                failures.append(f"{type(ex).__name__}: {ex}")
            if len(failures) >= most:
                return None, failures
            time.sleep(delay)

    def run(batches: Iterator) -> Iterator:
        import pandas as pd
        for pdf in batches:
            for day, name, path, queue in zip(pdf["day_id"], pdf["filename"], pdf["path"], pdf["queue"]):
                text, failures = attempt(path, large_tries if queue == "sequential" else tries)
                yield pd.DataFrame({"day_id": [day], "filename": [name], "parsed_content": [text],
                                    "parse_error": [None if text is not None else failures[-1]], "failures": [failures]})

    bins = files.agg(F.coalesce(F.max("bin"), F.lit(0))).first()[0] + 1
    return (files.select("day_id", "filename", "path", "queue", "bin").repartitionById(bins, F.col("bin"))
            .mapInPandas(run, _PARSE_OUT))


def intake_stage(spark: SparkSession, inbox_root: str, day_id: str, log: DataFrame, parsed: DataFrame,
                 parser: Parser, *, run_id: str, at: Column | None = None, materialize: bool = True,
                 bin_bytes: int = IN.BIN_BYTES, **parsing) -> dict[str, DataFrame]:
    """One batch: register new files, parse what is queued, apply the log transitions.

    Returns ``new_log_rows`` (append), ``parsed_documents`` (append), ``log``
    (the batch's log after the parsing transition, mark-parsed, parse errors and reconciliation, for a
    partition rewrite), ``events`` (with the run's own and one per failed try that was followed by another), ``outcome`` (run status counts) and ``quarantine``
    (files to move away after repeated failures).  ``parsing``: options of ``run_parser``.
    """
    at = at if at is not None else F.current_timestamp()
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true") \
        .load(f"{inbox_root.rstrip('/')}/{day_id}")
    listing = IN.classify_size(IN.path_keys(files.select("path", "length"))).withColumn("day_id", F.lit(day_id))
    day_log, day_parsed = log.where(F.col("day_id") == day_id), parsed.where(F.col("day_id") == day_id)
    new_rows = IN.register(listing, day_parsed, day_log, run_id, at)
    log1 = day_log.unionByName(conform(new_rows, day_log.schema), allowMissingColumns=True)

    queue = IN.parse_queue(listing, day_parsed)
    # 'parsing' from pending and from error: a file that failed before is tried again and counted
    log1 = ST.guarded_update(log1, queue.select(*KEYS), {
        "status": F.lit("parsing"), "started_at": at, "error_message": F.lit(None), "error_stage": F.lit(None),
        "retry_count": F.coalesce("retry_count", F.lit(0)) + (F.col("status") == "error").cast("int")},
        guard=F.col("status").isin("pending", "error"), run_id=run_id).drop("updated")
    todo = IN.byte_bins(queue, bin_bytes).select(*KEYS, "path", "queue", "bin")
    todo = cut_lineage(todo, f"{run_id}-{day_id}/bins") if materialize else todo
    out = run_parser(todo, parser, **parsing)
    out = cut_lineage(out, f"{run_id}-{day_id}/parsed") if materialize else out  # never parse twice
    ok = out.where(F.col("parse_error").isNull())
    parsed_rows = conform(ok.join(listing.select(*KEYS, "folder_id", F.col("path").alias("source_path"),
                                                 F.col("length").alias("_len")), list(KEYS))
                          .withColumn("file_size_mb", F.col("_len") / IN.MB)
                          .withColumn("n_pages", n_pages_expr(F.col("parsed_content")))
                          .withColumn("parsed_at", at).withColumn("run_id", F.lit(run_id)), PARSED_DOCUMENTS)

    log2 = ST.mark_parsed(log1, parsed_rows, run_id, at).drop("updated")
    errors = out.where(F.col("parse_error").isNotNull()).select(
        *KEYS, F.col("parse_error").alias("err"), (F.size("failures") - 1).alias("retries"))
    log3 = ST.guarded_update(log2, errors, {"status": F.lit("error"), "error_message": F.col("u_err"),
                                            "error_stage": F.lit("parsing"), "completed_at": at,
                                            "retry_count": F.greatest(F.coalesce("retry_count", F.lit(0)), F.col("u_retries"))},
                             guard=F.col("status").isin("pending", "parsing"), run_id=run_id).drop("updated")
    again = out.select(*KEYS, F.posexplode("failures").alias("n", "err"), (F.size("failures") - 1).alias("last"), "parse_error")
    again = again.where((F.col("n") < F.col("last")) | F.col("parse_error").isNull())
    events = (IN.flag_null_pages(parsed_rows, at, run_id)
              .unionByName(ST.event_rows(again, "parse", "retry", "pipeline", at, run_id=run_id, error_message=F.col("err"),
                                         detail=F.concat(F.lit("attempt "), (F.col("n") + 1).cast("string"))))
              .unionByName(IN.reconcile_events(log3, at, run_id))
              .unionByName(ST.event_rows(errors, "parse", "error", "pipeline", at, run_id=run_id,
                                         error_message=F.col("err"))))
    log4 = ST.reconcile_stuck(log3, run_id, at).drop("updated")
    poison = IN.quarantine_plan(log4, inbox_root.rstrip("/").rsplit("/", 1)[0])
    outcome = IN.run_outcome(log4, "parse")
    n = RE.tally(spark, day_id, n_inbox=listing, n_to_parse=queue, n_new=new_rows,
                 n_oversized_new=new_rows.where(F.col("status") == "skipped"))
    done = n.join(outcome.select("day_id", "run_status", "parsed", "errored"), "day_id", "left")
    status = (F.when(F.col("n_inbox") == 0, "NO_FILES")
              .when((F.col("n_to_parse") == 0) & (F.col("n_oversized_new") == 0), "ALL_ALREADY_PARSED").otherwise(F.col("run_status")))
    events = (events
              .unionByName(RE.run_event(spark, "parse", "run_started", day_id, at, run_id, F.lit(f"inbox={inbox_root}/{day_id}")))
              .unionByName(RE.counted_event(n, "parse", "registered", at, run_id, RE.text(F.col("n_new"), " files registered")))
              .unionByName(ST.event_rows(poison, "parse", "quarantined", "pipeline", at, detail=F.col("dst"), run_id=run_id,
                                         error_message=F.col("reason")))
              .unionByName(RE.counted_event(done, "parse", "run_completed", at, run_id, RE.text(
                  "parsed=", F.coalesce("parsed", F.lit(0)), " errored=", F.coalesce("errored", F.lit(0))), status)))
    return {"new_log_rows": new_rows, "parsed_documents": parsed_rows, "log": conform(log4, PROCESSING_LOG),
            "events": events, "outcome": outcome, "queue": queue, "quarantine": poison}
