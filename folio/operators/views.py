"""Status views over the state tables (file status, funnel, lifecycle, ...).

Each view is a function ``DataFrame -> DataFrame``.  Filters on ``day_id`` are
applied by callers before or after; ``day_id`` is the leading key of every
grouping and window, so Catalyst pushes such filters below them to the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.common import KEYS, count_if, latest_per_key, weighted_if

# Processing-status precedence of the file-status view
# (lower wins): done, parsed, manual, parsing, error, skipped, pending, else 8.
STATUS_RANK = ("done", "parsed", "manual", "parsing", "error", "skipped", "pending")
SPLIT_CARRY = ("needs_review", "boundary_source", "n_documents", "model_used", "predicted_starts",
               "total_pages", "split_seq")


def status_rank(status: Column) -> Column:
    expr = F.lit(len(STATUS_RANK) + 1)
    for i, s in reversed(list(enumerate(STATUS_RANK, start=1))):
        expr = F.when(status == s, F.lit(i)).otherwise(expr)
    return expr


def latest_split(split: DataFrame, tiebreak: str | None = "split_seq") -> DataFrame:
    """WIN2: latest prediction row per (day_id, filename) by processing_timestamp."""
    order = [F.col("processing_timestamp").desc()]
    if tiebreak and tiebreak in split.columns:
        order.append(F.col(tiebreak).desc())
    return latest_per_key(split, KEYS, order)


def file_status(log: DataFrame, split: DataFrame, log_tiebreak: str | None = "log_seq",
                split_tiebreak: str | None = "split_seq") -> DataFrame:
    """WIN1: furthest-progressed log row per key, joined 1:1 with the latest prediction."""
    order = [status_rank(F.col("status")).asc(), F.col("created_at").desc()]
    if log_tiebreak and log_tiebreak in log.columns:
        order.append(F.col(log_tiebreak).desc())
    best = latest_per_key(log, KEYS, order)
    carry = [c for c in SPLIT_CARRY if c in split.columns and c not in best.columns]
    s = latest_split(split, split_tiebreak).select(*KEYS, *carry)
    return best.join(s, list(KEYS), "left")


def funnel_counters() -> dict[str, Column]:
    """What the funnel counts: a condition per counter."""
    st, sf = F.col("status"), F.col("sftp_delivery_status")
    return {"n_files": F.lit(True),
            **{f"n_{name}": st == value for name, value in (
                ("pending", "pending"), ("parsing", "parsing"), ("parsed", "parsed"), ("predicted", "done"), ("error", "error"),
                ("skipped", "skipped"), ("manual", "manual"))},
            **{f"n_{name}": sf == value for name, value in (
                ("sftp_pending", "pending"), ("delivered", "delivered"), ("sftp_failed", "failed"), ("deferred", "deferred"))},
            "n_needs_review": F.col("needs_review")}


def funnel(status: DataFrame) -> DataFrame:
    """AGG1: per-batch counts on both status axes."""
    return status.groupBy("day_id").agg(*[count_if(c).alias(n) for n, c in funnel_counters().items()])


def event_marks(events: DataFrame) -> DataFrame:
    """Last event time and whether the annotation gate was opened, per batch."""
    return events.groupBy("day_id").agg(
        F.max("event_ts").alias("last_event_ts"),
        F.max(F.col("event_type") == "awaiting_annotation").alias("gate_opened"),
    )


def lifecycle(f: DataFrame) -> Column:
    d = F.col("n_delivered")
    return (F.when((d > 0) & (d >= F.col("n_files") - F.col("n_skipped") - F.col("n_manual") - F.col("n_error")),
                   "delivered")
            .when(F.col("n_sftp_pending") + F.col("n_sftp_failed") + F.col("n_deferred") > 0, "delivering")
            .when(F.col("gate_opened") & (d == 0), "awaiting_annotation")
            .when(F.col("n_predicted") > 0, "predicted")
            .when((F.col("n_parsing") > 0) | (F.col("n_parsed") > 0), "parsing")
            .when(F.col("n_pending") > 0, "uploaded")
            .otherwise("unknown"))


def batch_status(fun: DataFrame, events: DataFrame) -> DataFrame:
    """AGG2: coarse lifecycle per batch (funnel left-joined with event marks)."""
    return with_lifecycle(fun, event_marks(events))


def with_lifecycle(fun: DataFrame, marks: DataFrame) -> DataFrame:
    """AGG2 over counts and event marks that are at hand."""
    j = fun.join(marks, "day_id", "left")
    return j.select("*", lifecycle(j).alias("lifecycle"),
                    ((F.col("n_error") + F.col("n_sftp_failed")) > 0).alias("has_errors"))


def run_summary(events: DataFrame) -> DataFrame:
    """AGG3: per (run, batch, stage) time window, duration and event counts."""
    et = F.col("event_type")
    ts = F.col("event_ts").cast("timestamp")
    return events.groupBy("run_id", "day_id", "stage").agg(
        F.min("event_ts").alias("started_at"),
        F.max("event_ts").alias("last_event_at"),
        ((F.unix_timestamp(F.max(ts)) - F.unix_timestamp(F.min(ts))) / F.lit(60.0))
        .cast("decimal(10,1)").alias("duration_min"),
        count_if(et == "error").alias("n_errors"),
        count_if(et == "needs_review").alias("n_needs_review"),
        count_if(et == "delivered").alias("n_delivered"),
        count_if(et == "deferred").alias("n_deferred"),
        count_if(et == "quarantined").alias("n_quarantined"),
        F.max(F.when(et == "run_completed", F.col("new_status"))).alias("run_outcome"),
    )


def _older(ts: str, as_of: Column, hours: int) -> Column:
    return F.col(ts) < (as_of - F.expr(f"INTERVAL {hours} HOURS"))


def stuck_files(status: DataFrame, as_of: Column) -> DataFrame:
    """AGG4: files needing attention with the first matching reason.

    ``as_of`` is the clock (a timestamp column/literal) so results are repeatable.
    The last reason can never be emitted: the WHERE clause only admits pending
    deliveries older than 24 h, which an earlier branch already claims.
    """
    cols = set(status.columns)

    def c(name: str, typ: str = "string") -> Column:
        return F.col(name) if name in cols else F.lit(None).cast(typ)

    st, sf = F.col("status"), F.col("sftp_delivery_status")
    needs = F.coalesce(c("needs_review", "boolean"), F.lit(False))
    reason = (
        F.when(st == "error", F.concat(F.lit("error at "), F.coalesce(c("error_stage"), F.lit("?")),
                                       F.lit(": "), F.coalesce(c("error_message"), F.lit(""))))
        .when(sf == "failed", F.concat(F.lit("sftp failed: "), F.coalesce(c("sftp_delivery_error"), F.lit(""))))
        .when(sf == "deferred", F.concat(F.lit("deferred: "),
                                         F.coalesce(c("sftp_delivery_error"), F.lit("remote folder missing"))))
        .when((st == "parsing") & _older("started_at", as_of, 2), F.lit("stuck in parsing > 2h"))
        .when((st == "parsed") & _older("completed_at", as_of, 12), F.lit("parsed but never split (> 12h)"))
        .when((sf == "pending") & _older("completed_at", as_of, 24), F.lit("awaiting sftp > 24h"))
        .when(needs & sf.isNull(), F.concat(F.lit("needs review ("), F.coalesce(c("boundary_source"), F.lit("?")),
                                            F.lit(") — delivery blocked")))
        .when((sf == "pending") & c("archived_path").isNull() & _older("completed_at", as_of, 2),
              F.lit("split but not archived (crash between passes?)")))
    keep = ((st == "error") | sf.isin("failed", "deferred")
            | ((st == "parsing") & _older("started_at", as_of, 2))
            | ((st == "parsed") & _older("completed_at", as_of, 12))
            | ((sf == "pending") & _older("completed_at", as_of, 24))
            | (needs & sf.isNull()))
    return status.where(keep).withColumn("stuck_reason", reason)


def delivery_board(status: DataFrame) -> DataFrame:
    """AGG5: delivery completeness per (day, folder) in split-PDF units."""
    sf = F.col("sftp_delivery_status")
    w = F.coalesce(F.col("n_documents"), F.lit(0))
    target = F.col("sftp_target_folder") if "sftp_target_folder" in status.columns else F.lit(None).cast("string")
    return (status.where(sf.isNotNull()).groupBy("day_id", "folder_id").agg(
        F.sum(w).cast("bigint").alias("n_files"),
        weighted_if(sf == "delivered", w).alias("n_delivered"),
        weighted_if(sf == "pending", w).alias("n_pending"),
        weighted_if(sf == "failed", w).alias("n_failed"),
        weighted_if(sf == "deferred", w).alias("n_deferred"),
        F.max("sftp_delivered_at").alias("last_delivered_at"),
        F.max(target).alias("sftp_target_folder"),
    ))


def needs_review(split: DataFrame) -> DataFrame:
    """BND15: the [1]-fallback review queue."""
    return split.where(F.col("needs_review") == F.lit(True))


def recent_events(events: DataFrame, n: int = 30, day_id: str | None = None) -> DataFrame:
    """SRT1: newest events first, filtered before the limit (T11)."""
    e = events if day_id is None else events.where(F.col("day_id") == day_id)
    order = [F.col("event_ts").desc()] + ([F.col("event_id").desc()] if "event_id" in e.columns else [])
    return e.orderBy(*order).limit(n)


def recent_runs(summary: DataFrame, n: int = 40, day_id: str | None = None) -> DataFrame:
    """SRT2: latest run/stage windows, top-n by start."""
    s = summary if day_id is None else summary.where(F.col("day_id") == day_id)
    return s.orderBy(F.col("started_at").desc(), "run_id", "day_id", "stage").limit(n)


def search_files(status: DataFrame, day_id: str | None = None, st: str | None = None,
                 q: str | None = None, limit: int = 500) -> DataFrame:
    """INT14: optional day, status on either axis, LIKE %q% on filename or folder."""
    df = status
    if day_id:
        df = df.where(F.col("day_id") == day_id)
    if st:
        df = df.where((F.col("status") == st) | (F.col("sftp_delivery_status") == st))
    if q:
        pat = f"%{q}%"  # '_' and '%' inside q stay LIKE wildcards, as in the reference
        df = df.where(F.col("filename").like(pat) | F.col("folder_id").like(pat))
    return df.orderBy("filename", "day_id").limit(limit)


# The order in which each view is listed (SRT3, DLV8).
LISTED = {"batch_status": ("-day_id",), "stuck_files": ("-day_id", "stuck_reason", "filename"),
          "delivery_board": ("-day_id", "folder_id"), "needs_review": ("-day_id", "filename"), "deferred_files": ("filename", "day_id")}


def in_order(df: DataFrame, view: str) -> DataFrame:
    """SRT3: a view's rows in its listing order.  Sort only what is shown; with a limit Spark keeps the
    first rows of each task and never sorts the whole view."""
    return df.orderBy(*[F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in LISTED[view]])


def deferred_files(status: DataFrame, day_id: str | None = None) -> DataFrame:
    """DLV8: deferred deliveries for re-delivery."""
    df = status.where(F.col("sftp_delivery_status") == "deferred")
    if day_id:
        df = df.where(F.col("day_id") == day_id)
    return df


def file_detail(status: DataFrame, events: DataFrame, responses: DataFrame | None,
                day_id: str, filename: str, n_events: int = 100, n_responses: int = 20
                ) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """AGG13: status row, last events, last responses (text cut to 2000) for one file."""
    key = (F.col("day_id") == day_id) & (F.col("filename") == filename)
    st = status.where(key)
    last = lambda df, ts, ids: df.orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in ids if c in df.columns])
    ev = last(events.where(key), "event_ts", ["event_id"]).limit(n_events)
    rs = None
    if responses is not None:
        rs = (last(responses.where(key), "processing_timestamp", ["raw_response", "stage", "model_used"]).limit(n_responses)
              .withColumn("raw_response", F.left(F.col("raw_response"), F.lit(2000))))
    return st, ev, rs


VOLUMES = ("inbox", "validation", "ground_truth", "archive")


def volume_counts(manifest: DataFrame, volumes: Sequence[str] = VOLUMES) -> DataFrame:
    """AGG10: physical file counts per batch and volume (one pass, pivot on fixed values)."""
    p = manifest.groupBy("day_id").pivot("volume", list(volumes)).agg(F.count(F.lit(1)))
    return p.select("day_id", *[F.coalesce(F.col(v), F.lit(0)).cast("bigint").alias(f"n_{v}") for v in volumes])


def flow_counters(fun: DataFrame, volumes: DataFrame, gate: DataFrame | None = None) -> DataFrame:
    """AGG9: live-flow stage counters and their error counters per batch.

    Processing and delivery are separate axes: a file stays 'done' while its
    delivery advances, so delivery buckets are not added to 'parsed' or
    'predicted'.
    """
    j = fun.join(volumes, "day_id", "left")
    if gate is not None:
        j = j.join(gate.select("day_id", "n_sampled", "n_annotated"), "day_id", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") if c in j.columns else F.lit(0).cast("bigint")
    return j.select(
        F.col("day_id"),
        z("n_inbox").alias("inbox"),
        (z("n_parsed") + z("n_predicted")).alias("parsed"),
        z("n_predicted").alias("predicted"),
        z("n_annotated").alias("gate"),
        (z("n_sftp_pending") + z("n_delivered") + z("n_sftp_failed") + z("n_deferred")).alias("split"),
        z("n_delivered").alias("delivered"),
        z("n_error").alias("parsed_errors"),
        z("n_needs_review").alias("predicted_errors"),
        (z("n_sampled") - z("n_annotated")).alias("gate_errors"),
        z("n_deferred").alias("split_errors"),
        z("n_sftp_failed").alias("delivered_errors"))
