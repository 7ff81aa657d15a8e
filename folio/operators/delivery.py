"""Delivery reconciliation over listings (DLV1-7): routing, size checks, folder
completeness, per-file outcome and failure reason.  The transfer itself is
not built; its facts arrive as listings (local files, remote folders, remote sizes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.common import KEYS, count_if
from folio.operators.state import guarded_update

OWN_PDF_RE = r"^(.*)_\d{3,}\.pdf$"


def delivery_queue(log: DataFrame) -> DataFrame:
    """DLV1: packages split and waiting for delivery."""
    return log.where((F.col("sftp_delivery_status") == "pending") & (F.col("status") == "done"))


def route_delivery(queue: DataFrame, local: DataFrame, remote_folders: DataFrame, remote_base: str) -> DataFrame:
    """DLV2: one row per (package, output PDF) with its route.

    ``local`` lists output PDFs (folder_id, out_name); each package takes the
    PDFs named after it (``<filename>_NNN.pdf``), an equi-join on
    (folder_id, filename) -- not every PDF of a shared folder, which would pair
    every package of a folder with every file in it.  A package with no local
    PDF gets route ``missing_local``; one whose remote folder is absent
    ``deferred``; the rest ``upload``.
    """
    own = local.withColumn("filename", F.regexp_extract("out_name", OWN_PDF_RE, 1))
    rf = remote_folders.select("folder_id").distinct().withColumn("_remote", F.lit(True))
    j = queue.join(own, ["folder_id", "filename"], "left").join(rf, "folder_id", "left")
    route = (F.when(F.col("out_name").isNull(), F.lit("missing_local"))
             .when(F.col("_remote").isNull(), F.lit("deferred")).otherwise(F.lit("upload")))
    remote_folder = F.concat(F.lit(remote_base.rstrip("/") + "/"), F.col("folder_id"))
    return j.select(*queue.columns, "out_name", *[c for c in ("local_size", "upload_error") if c in own.columns],
                    route.alias("route"), remote_folder.alias("remote_folder"),
                    F.concat(remote_folder, F.lit("/"), F.col("out_name")).alias("remote_path"))


def verify_sizes(tasks: DataFrame, remote: DataFrame) -> DataFrame:
    """DLV3: local size equals remote size; missing remote file is its own issue."""
    r = remote.select("remote_path", "remote_size")
    j = tasks.join(r, "remote_path", "left")
    ok = F.col("remote_size").isNotNull() & (F.col("remote_size") == F.col("local_size"))
    issue = (F.when(F.col("remote_size").isNull(), F.lit("file not found on remote after upload"))
             .when(~ok, F.concat(F.lit("size mismatch: local="), F.col("local_size").cast("string"),
                                 F.lit("B remote="), F.col("remote_size").cast("string"), F.lit("B"))))
    return j.withColumn("verified", ok).withColumn("issue", issue)


def folder_completeness(tasks: DataFrame) -> DataFrame:
    """DLV4: per remote folder, expected files minus files present remotely."""
    return tasks.groupBy("folder_id", "remote_folder").agg(
        F.count(F.lit(1)).alias("n_expected"),
        count_if(F.col("remote_size").isNotNull()).alias("n_present")).withColumn(
        "n_missing", F.col("n_expected") - F.col("n_present")).withColumn("complete", F.col("n_missing") == 0)


def file_outcome(verified: DataFrame, folders: DataFrame) -> DataFrame:
    """DLV5/DLV6: per package delivered only if every PDF was uploaded and verified in a complete folder;
    otherwise the reason by precedence upload error > size check > incomplete folder."""
    f = folders.select("folder_id", "complete", "n_missing")
    j = verified.join(f, "folder_id", "left")
    upload_err = F.col("upload_error") if "upload_error" in j.columns else F.lit(None).cast("string")
    good = F.col("verified") & F.coalesce(F.col("complete"), F.lit(False)) & upload_err.isNull()
    agg = j.groupBy(*[c for c in ("day_id", "filename") if c in j.columns]).agg(
        F.count(F.lit(1)).alias("n_expected"), count_if(good).alias("n_ok"),
        F.min_by(upload_err, F.when(upload_err.isNotNull(), F.col("out_name"))).alias("_upload"),
        F.min_by(F.col("issue"), F.when(F.col("issue").isNotNull(), F.col("out_name"))).alias("_verify"),
        F.min_by(F.concat(F.lit("folder incomplete: "), F.col("folder_id"), F.lit(" missing "),
                          F.col("n_missing").cast("string"), F.lit(" files")),
                 F.when(~F.coalesce(F.col("complete"), F.lit(False)), F.col("out_name"))).alias("_folder"),
        F.max(F.col("remote_folder")).alias("remote_folder"))
    delivered = F.col("n_ok") == F.col("n_expected")
    reason = F.coalesce(F.concat(F.lit("upload error: "), F.substring("_upload", 1, 300)),
                        F.concat(F.lit("verify failed: "), F.substring("_verify", 1, 300)), F.col("_folder"))
    out = agg.withColumn("outcome", F.when(delivered, F.lit("delivered")).otherwise(F.lit("failed"))) \
             .withColumn("fail_reason", F.when(~delivered, reason))
    etype = (F.when(F.col("fail_reason").startswith("verify"), F.lit("verify_failed"))
             .when(F.col("fail_reason").startswith("folder"), F.lit("folder_incomplete"))
             .when(F.col("fail_reason").isNotNull(), F.lit("error")))
    return out.withColumn("event_type", F.when(delivered, F.lit("delivered")).otherwise(etype)) \
              .drop("_upload", "_verify", "_folder")


def apply_delivery(log: DataFrame, outcome: DataFrame, deferred: DataFrame, remote_base: str, at: Column,
                   run_id: str | None = None) -> DataFrame:
    """DLV7: in the order the delivery job writes them: deferred (remote folder
    missing) first, then delivered (guarded on status 'done'), then failed with
    its reason.  The three sets are one update relation with a column each, so the log is
    joined once; a later set overrules an earlier one."""
    one = lambda df, kind, value: df.select(*KEYS, F.lit(kind).alias("kind"), value.alias("value"))
    base = f"remote folder missing: {remote_base.rstrip('/')}/"
    updates = (one(deferred, "deferred", F.concat(F.lit(base), F.col("folder_id")))
               .unionByName(outcome.where(F.col("outcome").isin("delivered", "failed")).select(
                   *KEYS, F.col("outcome").alias("kind"),
                   F.when(F.col("outcome") == "delivered", F.col("remote_folder")).otherwise(F.col("fail_reason")).alias("value"))))
    said = lambda k: F.max(F.when(F.col("kind") == k, F.struct("value"))).alias(k)
    t = updates.groupBy(*KEYS).agg(said("deferred"), said("delivered"), said("failed"))
    sent = F.col("u_delivered").isNotNull() & (F.col("status") == "done")
    state = (F.when(F.col("u_failed").isNotNull(), F.lit("failed")).when(sent, F.lit("delivered"))
             .when(F.col("u_deferred").isNotNull(), F.lit("deferred")).otherwise(F.col("sftp_delivery_status")))
    error = (F.when(F.col("u_failed").isNotNull(), F.col("u_failed.value")).when(sent, F.lit(None))
             .when(F.col("u_deferred").isNotNull(), F.col("u_deferred.value")).otherwise(F.col("sftp_delivery_error")))
    return guarded_update(log, t, {
        "sftp_delivery_status": state, "sftp_delivery_error": error,
        "sftp_delivered_at": F.when(sent, at).otherwise(F.col("sftp_delivered_at")),
        "sftp_target_folder": F.when(sent, F.col("u_delivered.value")).otherwise(F.col("sftp_target_folder"))},
        guard=sent | F.col("u_deferred").isNotNull() | F.col("u_failed").isNotNull(), run_id=run_id)
