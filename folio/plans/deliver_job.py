"""The delivery jobs as functions: check export (sample + records) and deliver
(segments, archive, routing, verification, outcome), composed from the operators.

Physical work (writing PDFs, moving files, transferring them) happens outside
Spark; its facts come back as listings (DataFrames), which these jobs turn into
log transitions and events.  Every result is a DataFrame for the caller to write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.common import KEYS
from folio.operators import delivery as DL
from folio.operators import run_events as RE
from folio.operators import sampling as SM
from folio.operators import segments as SE
from folio.operators import views as V
from folio.operators.state import event_rows
from folio.sources.sinks import cut_lineage

MISSING_BOTH = "missing from both inbox and archive"


def export_stage(split: DataFrame, manifest: DataFrame, day_id: str, sample_pct: float, *, run_id: str | None = None,
                 at: Column | None = None) -> dict[str, DataFrame]:
    """Check export: the batch's annotation sample and one record per sampled file
    that has no ground truth yet.  Opens the annotation gate (event ``awaiting_annotation``)."""
    at = at if at is not None else F.current_timestamp()
    spark = split.sparkSession
    latest = V.latest_split(split.where(F.col("day_id") == day_id))
    sample = SM.annotation_sample(latest, sample_pct)
    gt = manifest.where((F.col("volume") == "ground_truth") & (F.col("day_id") == day_id)).select(*KEYS)
    pending = sample.join(gt, list(KEYS), "left_anti")
    n = RE.tally(spark, day_id, n_split=latest, n_sampled=sample, n_pending=pending)
    status = (F.when(F.col("n_split") == 0, "NO_SPLIT_RESULTS").when(F.col("n_sampled") == 0, "NO_FILES_IN_VALIDATION")
              .when(F.col("n_pending") == 0, "ALL_ANNOTATED").otherwise("success"))
    detail = RE.text("n_sampled=", F.col("n_sampled"), " to_annotate=", F.col("n_pending"), " already_annotated=",
                     F.col("n_sampled") - F.col("n_pending"), f" sample_pct={sample_pct}")
    events = (RE.run_event(spark, "check_export", "run_started", day_id, at, run_id, F.lit(f"sample_pct={sample_pct}"))
              .unionByName(RE.counted_event(n.where(status == "success"), "check_export", "awaiting_annotation", at, run_id, detail))
              .unionByName(RE.counted_event(n, "check_export", "run_completed", at, run_id, detail, status)))
    return {"sample": sample, "records": SM.export_predictions(pending, latest), "events": events}


def deliver_stage(split: DataFrame, log: DataFrame, manifest: DataFrame, day_id: str, *,
                  gt_docs: DataFrame | None, physical_pages: DataFrame | None, local: DataFrame,
                  remote_folders: DataFrame, remote_files: DataFrame, root: str, remote_base: str,
                  run_id: str, at: Column | None = None) -> dict[str, DataFrame]:
    """One batch from split predictions to delivery status.

    ``local`` lists written output PDFs (folder_id, out_name, local_size);
    ``remote_folders`` the folders present remotely (folder_id);
    ``remote_files`` the remote files after transfer (remote_path, remote_size).
    """
    at = at if at is not None else F.current_timestamp()
    day_log = log.where(F.col("day_id") == day_id)
    cand = SE.split_candidates(V.latest_split(split.where(F.col("day_id") == day_id)), day_log)
    gt_keys = manifest.where((F.col("volume") == "ground_truth") & (F.col("day_id") == day_id)).select(*KEYS)
    to_split, blocked = SE.review_block(cand, gt_keys)

    counts = physical_pages if physical_pages is not None else to_split.select(*KEYS).limit(0).withColumn(
        "n_pages", F.lit(None).cast("int"))
    rec = SE.reconcile_pages(to_split, counts)
    arch = SE.archive_outcome(to_split, manifest.where(F.col("day_id") == day_id), root)
    # a package that is archived already was split by an earlier run; one that is nowhere cannot be
    segs = SE.segments(rec.join(arch.where(F.col("archive_state") == "moved").select(*KEYS), list(KEYS), "left_semi"), gt_docs)
    ok = (rec.join(arch.where(F.col("archive_state") != "missing").select(*KEYS), list(KEYS))
          .select(*KEYS, F.concat(F.lit(f"{root}/output/"), F.col("day_id"), F.lit("/"), F.col("folder_id"))
                  .alias("output_folder"), F.col("total_pages").alias("n_pages")))
    err = arch.where(F.col("archive_state") == "missing").select(*KEYS, F.lit(MISSING_BOTH).alias("error"))
    log1 = SE.apply_split_outcome(day_log, ok, err, at, run_id).drop("updated")
    log2 = SE.apply_archive(log1, arch, run_id).drop("updated")

    queue = DL.delivery_queue(log2).select(*KEYS, "folder_id")
    tasks = DL.route_delivery(queue, local, remote_folders, remote_base)
    settled = cut_lineage(DL.verify_sizes(tasks, remote_files), f"{run_id}-{day_id}/delivery_checks")  # read by all that follows
    tasks, verified = settled.select(*tasks.columns), settled.where(F.col("route") == "upload")
    folders = DL.folder_completeness(verified)
    outcome = DL.file_outcome(verified, folders)
    deferred = tasks.where(F.col("route") == "deferred").groupBy(*KEYS).agg(F.max("folder_id").alias("folder_id"))
    log3 = DL.apply_delivery(log2, outcome, deferred, remote_base, at, run_id).drop("updated")

    missing_local = tasks.where(F.col("route") == "missing_local").select(*KEYS, "folder_id").distinct()
    events = (SE.blocked_events(blocked, at, run_id)
              .unionByName(event_rows(err, "pdf_split", "error", "pipeline", at, run_id=run_id,
                                      error_message=F.col("error")))
              .unionByName(event_rows(missing_local, "sftp_upload", "error", "pipeline", at, run_id=run_id,
                                      error_message=F.lit("local output folder missing")))
              .unionByName(event_rows(deferred, "sftp_upload", "deferred", "pipeline", at, run_id=run_id,
                                      detail=F.concat(F.lit(f"remote folder missing: {remote_base}/"),
                                                      F.col("folder_id"))))
              .unionByName(event_rows(outcome, "sftp_upload", F.col("event_type"), "pipeline", at, run_id=run_id,
                                      detail=F.when(F.col("outcome") == "delivered", F.col("remote_folder")),
                                      error_message=F.col("fail_reason")))
              .unionByName(event_rows(rec.where("page_count_changed"), "pdf_split", "status_change", "pipeline", at, run_id=run_id,
                                      detail=RE.text("page count reconciled: pdf=", F.col("total_pages"))))
              .unionByName(event_rows(arch.where(F.col("archived_path").isNotNull()), "pdf_split", "archived", "pipeline", at,
                                      run_id=run_id, detail=F.col("archived_path"))))
    spark = split.sparkSession
    n = RE.tally(spark, day_id, n_split=to_split, n_lost=err, n_queue=queue, n_tasks=tasks,
                 n_upload=tasks.where(F.col("route") == "upload"), n_failed=outcome.where(F.col("outcome") == "failed"))
    split_status = F.when(F.col("n_split") == 0, "NO_FILES_TO_SPLIT").when(F.col("n_lost") > 0, "partial_failure").otherwise("success")
    sent_status = (F.when(F.col("n_queue") == 0, "NO_FILES_PENDING").when(F.col("n_upload") == 0, "ALL_DEFERRED")
                   .when(F.col("n_failed") > 0, "partial_failure").otherwise("success"))
    for stage, detail, status in (("pdf_split", None, split_status), ("sftp_upload", f"remote_base={remote_base}", sent_status)):
        started = RE.run_event(spark, stage, "run_started", day_id, at, run_id, F.lit(detail))
        events = events.unionByName(started).unionByName(RE.counted_event(n, stage, "run_completed", at, run_id, None, status))
    return {"candidates": cand, "blocked": blocked, "segments": segs, "archive": arch, "tasks": tasks,
            "verified": verified, "folders": folders, "outcome": outcome, "log": log3, "events": events}
