"""Guarded state updates without row-level DML (UPD1-9, INT8, BND14, SNK2).

Parquet tables have no MERGE/UPDATE, so an update is a left join of the table
with the update keys and a ``when(matched & guard, new).otherwise(old)`` per
column.  Written back with dynamic partition overwrite only the touched
``day_id`` partitions are rewritten: ``sinks.rewrite_batches`` hands an update the rows of the targets' batches
only (``touched``).  Every action also yields its audit events.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.common import KEYS

# Columns an update may set (the reference's whitelist).
LOG_UPDATABLE = ("status", "error_message", "error_stage", "model_used", "n_pages", "n_documents_found",
                 "retry_count", "started_at", "completed_at", "archived_path", "sftp_delivered_at",
                 "sftp_target_folder", "sftp_delivery_status", "sftp_delivery_error")
STRANDED_MESSAGE = "stranded in parsing at end of run — see pipeline_events"


def touched(table: DataFrame, targets: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The rows of the batches that ``targets`` names.  On a table partitioned by ``day_id`` the semi join
    prunes partitions at run time."""
    if "day_id" not in keys or "day_id" not in table.columns:
        return table
    return table.join(targets.select("day_id").distinct(), "day_id", "left_semi").select(*table.columns)


def guarded_update(table: DataFrame, targets: DataFrame, sets: Mapping[str, Column],
                   guard: Column | None = None, keys: Sequence[str] = KEYS,
                   run_id: str | None = None, whitelist: Sequence[str] | None = LOG_UPDATABLE) -> DataFrame:
    """UPD1: set ``sets`` on the rows of ``table`` whose keys are in ``targets``
    and that satisfy ``guard``; stamps ``run_id`` on updated rows when given.

    ``targets`` holds the keys plus optional value columns; inside ``sets`` they
    are referenced as ``u_<name>``.  Duplicate target keys are collapsed first
    (a MERGE would fail on them); with values, the largest value tuple wins.
    """
    if whitelist is not None:
        bad = [c for c in sets if c not in whitelist]
        if bad:
            raise ValueError(f"columns not updatable: {bad}")
    vals = [c for c in targets.columns if c not in keys]
    t = targets.select(*keys, *[F.col(c).alias(f"u_{c}") for c in vals])
    if vals:
        t = t.groupBy(*keys).agg(F.max(F.struct(*[f"u_{c}" for c in vals])).alias("_u")).select(
            *keys, *[F.col(f"_u.u_{c}").alias(f"u_{c}") for c in vals])
    else:
        t = t.distinct()
    j = table.join(t.withColumn("_hit", F.lit(True)), list(keys), "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if guard is not None:
        hit = hit & F.coalesce(guard, F.lit(False))
    j = j.withColumn("_upd", hit)
    out = []
    for c in table.columns:
        if c in sets:
            out.append(F.when(F.col("_upd"), sets[c]).otherwise(F.col(c)).cast(table.schema[c].dataType).alias(c))
        elif c == "run_id" and run_id is not None:
            out.append(F.when(F.col("_upd"), F.lit(run_id)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out, F.col("_upd").alias("updated"))


def _null(t: str = "string") -> Column:
    return F.lit(None).cast(t)


def retry_parse(log: DataFrame, targets: DataFrame) -> DataFrame:
    """UPD2: error -> pending, error cleared, retry_count + 1."""
    return guarded_update(log, targets, {"status": F.lit("pending"), "error_message": _null(),
                                         "error_stage": _null(), "retry_count": F.col("retry_count") + 1},
                          guard=F.col("status") == "error")


def drop_artifacts(table: DataFrame, targets: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Delete the rows of ``table`` keyed by ``targets`` (anti join)."""
    return table.join(targets.select(*keys).distinct(), list(keys), "left_anti")


def retry_split(log: DataFrame, targets: DataFrame) -> DataFrame:
    """UPD3: done/error -> parsed with the document count cleared (artifacts are
    dropped separately with ``drop_artifacts`` on split_results, page_signals
    and package_summaries)."""
    return guarded_update(log, targets, {"status": F.lit("parsed"), "error_message": _null(), "error_stage": _null(),
                                         "n_documents_found": _null("int")},
                          guard=F.col("status").isin("done", "error"))


def retry_sftp(log: DataFrame, targets: DataFrame) -> DataFrame:
    """UPD4: failed/deferred delivery -> pending."""
    return guarded_update(log, targets, {"sftp_delivery_status": F.lit("pending"), "sftp_delivery_error": _null()},
                          guard=F.col("sftp_delivery_status").isin("failed", "deferred"))


def mark_manual(log: DataFrame, targets: DataFrame) -> DataFrame:
    """UPD5: terminal 'manual' from any status."""
    return guarded_update(log, targets, {"status": F.lit("manual")})


def approve_review(split: DataFrame, targets: DataFrame) -> DataFrame:
    """UPD6: needs_review = false on split_results."""
    return guarded_update(split, targets, {"needs_review": F.lit(False)}, whitelist=None)


def reset_deferred(log: DataFrame, day_id: str, names: DataFrame | None = None) -> DataFrame:
    """UPD7: deferred -> pending for the named files of a batch, or all of it."""
    if names is None:
        targets = log.where(F.col("day_id") == day_id).select(*KEYS).distinct()
    else:
        targets = names.select(F.lit(day_id).alias("day_id"), "filename")
    return guarded_update(log, targets, {"sftp_delivery_status": F.lit("pending"), "sftp_delivery_error": _null()},
                          guard=(F.col("sftp_delivery_status") == "deferred") & (F.col("day_id") == day_id))


def mark_parsed(log: DataFrame, parsed: DataFrame, run_id: str | None, at: Column) -> DataFrame:
    """INT8: pending/parsing -> parsed with the page count of the parse."""
    t = parsed.select(*KEYS, "n_pages")
    return guarded_update(log, t, {"status": F.lit("parsed"), "n_pages": F.col("u_n_pages"), "completed_at": at},
                          guard=F.col("status").isin("pending", "parsing"), run_id=run_id)


def mark_done(log: DataFrame, final: DataFrame, run_id: str | None, at: Column) -> DataFrame:
    """BND14: parsed -> done with the number of documents found."""
    t = final.select(*KEYS, F.size("predicted_starts").alias("n_documents"))
    return guarded_update(log, t, {"status": F.lit("done"), "n_documents_found": F.col("u_n_documents"),
                                   "completed_at": at}, guard=F.col("status") == "parsed", run_id=run_id)


def reconcile_stuck(log: DataFrame, run_id: str | None, at: Column) -> DataFrame:
    """INT10: nothing may stay 'parsing' at the end of a run -> error with a fixed message."""
    t = log.where(F.col("status") == "parsing").select(*KEYS).distinct()
    return guarded_update(log, t, {"status": F.lit("error"), "error_message": F.lit(STRANDED_MESSAGE),
                                   "error_stage": F.lit("parsing"), "completed_at": at},
                          guard=F.col("status") == "parsing", run_id=run_id)


def replace_files(existing: DataFrame, new: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """SNK2: delete-before-append, so a rerun never stacks a second row per file."""
    return existing.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(
        new, allowMissingColumns=True)


def event_rows(df: DataFrame, stage: str, event_type: str | Column, actor: str, at: Column,
               detail: Column | None = None, run_id: str | None = None, old_status: Column | None = None,
               new_status: Column | None = None, error_message: Column | None = None) -> DataFrame:
    """SNK4 rows in the pipeline_events layout; ids are content hashes (stable
    under task retries, unlike random UUIDs); error text is cut to 2000 chars."""
    def col_or_null(name: str) -> Column:
        return F.col(name) if name in df.columns else _null()

    et = event_type if isinstance(event_type, Column) else F.lit(event_type)
    det = detail if detail is not None else _null()
    err = F.substring(error_message, 1, 2000) if error_message is not None else _null()
    base = df.select(
        F.lit(run_id).cast("string").alias("run_id"), col_or_null("day_id").alias("day_id"),
        F.lit(stage).alias("stage"), et.alias("event_type"), col_or_null("filename").alias("filename"),
        col_or_null("folder_id").alias("folder_id"),
        (old_status if old_status is not None else _null()).alias("old_status"),
        (new_status if new_status is not None else _null()).alias("new_status"),
        det.alias("detail"), err.alias("error_message"), F.lit(actor).alias("actor"), at.alias("event_ts"))
    eid = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in base.columns]), 256)
    return base.select(F.substring(eid, 1, 32).alias("event_id"), *base.columns)


# Event type and detail of each operator action.
ACTION_EVENTS = {
    "retry-parse": ("requeued", "retry parse: error → pending"),
    "retry-split": ("requeued", "hard re-split: artifacts deleted, status → parsed"),
    "retry-sftp": ("requeued", "retry sftp: → pending"),
    "mark-manual": ("marked_manual", "handled manually"),
    "approve-review": ("review_approved", "unsplit delivery approved by reviewer"),
}


def action_events(targets: DataFrame, action: str, actor: str, at: Column) -> DataFrame:
    """UPD8: one 'dashboard' event per targeted file (also when nothing matched, as
    the reference does; ``guarded_update(...).updated`` tells what changed)."""
    etype, detail = ACTION_EVENTS[action]
    return event_rows(targets, "dashboard", etype, actor, at, detail=F.lit(detail))


def eligible_actions(stuck: DataFrame) -> DataFrame:
    """UPD9: the actions offered per stuck file."""
    st, stage, sf = F.col("status"), F.col("error_stage"), F.col("sftp_delivery_status")
    acts = F.array_compact(F.array(
        F.when((st == "error") & (stage == "parsing"), F.lit("retry-parse")),
        F.when((st == "error") & (stage == "pdf_split"), F.lit("retry-split")),
        F.when(sf.isin("failed", "deferred"), F.lit("retry-sftp")),
        F.when(F.coalesce(F.col("needs_review"), F.lit(False)), F.lit("approve-review")),
        F.lit("mark-manual")))
    return stuck.withColumn("actions", acts)


def batch_actions(batches: DataFrame) -> DataFrame:
    """UPD9 (batch level): which job launches a batch offers."""
    life = F.col("lifecycle")
    acts = F.array_compact(F.array(
        F.when(life.isin("uploaded", "parsing", "unknown") | (F.col("n_inbox") > F.col("n_files")), F.lit("run-ingest")),
        F.when(life == "awaiting_annotation", F.lit("annotate")),
        F.when(life.isin("annotated", "predicted"), F.lit("split-and-upload")),
        F.when(life == "delivering", F.lit("resume-delivery"))))
    return batches.withColumn("actions", acts)
