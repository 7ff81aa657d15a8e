"""Segment, delivery, sampling, export, flow and end-to-end queries
(SEG1-6, WIN3-5, AGG9, AGG12, DLV1-7, SMP1, SNK6, split_job)."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions.common import KEYS, array_text
from folio.operators import evaluation as EV
from folio.operators import delivery as DL
from folio.operators import sampling as SM
from folio.operators import segments as SE
from folio.operators import views as V
from folio.plans import fixtures as fx
from folio.plans.q_evaluation import ORDER_DAY_SQL, order_days
from folio.plans.q_intake import ROOT, log_df
from folio.plans.q_views import AS_OF_TEXT, FILE_STATUS_CTES, as_of, funnel_df, status_df
from folio.plans.registry import query
from folio.sources.sinks import cut_lineage

REMOTE_BASE = "/remote/out"

# ---- segments -------------------------------------------------------------------------


def candidates(spark, sf_dir):
    return SE.split_candidates(V.latest_split(fx.fx_split(spark, sf_dir)), fx.fx_log(spark, sf_dir))


CAND_SQL = f"""{FILE_STATUS_CTES},
cand AS (SELECT s.day_id, s.filename, s.folder_id, s.total_pages, s.n_documents, coalesce(s.needs_review, false) AS needs_review
  FROM latest s WHERE NOT EXISTS (SELECT 1 FROM fx_log l WHERE l.day_id = s.day_id AND l.filename = s.filename
    AND l.sftp_delivery_status IS NOT NULL))"""


@query("split_candidates", f"WITH {CAND_SQL} SELECT * FROM cand")
def q_split_candidates(spark, sf_dir):
    return candidates(spark, sf_dir).select("day_id", "filename", "folder_id", "total_pages", "n_documents",
                                            "needs_review")


@query("review_block", f"""WITH {CAND_SQL},
g AS (SELECT DISTINCT day_id, filename FROM fx_manifest WHERE volume = 'ground_truth')
SELECT c.day_id, c.filename, c.needs_review, g.day_id IS NOT NULL AS has_gt,
  c.needs_review AND g.day_id IS NULL AS blocked
FROM cand c LEFT JOIN g ON g.day_id = c.day_id AND g.filename = c.filename""")
def q_review_block(spark, sf_dir):
    gt = fx.fx_manifest(spark, sf_dir).where(F.col("volume") == "ground_truth")
    ok, blocked = SE.review_block(candidates(spark, sf_dir), gt)
    cols = ["day_id", "filename", "needs_review", "has_gt"]
    return (ok.select(*cols, F.lit(False).alias("blocked"))
            .unionByName(blocked.select(*cols, F.lit(True).alias("blocked"))))


def seg_cands(spark, sf_dir):
    """Model boundaries of the evaluation adapter; its split-time page count is the
    responses adapter's (so page counts disagree with the physical pages)."""
    s = fx.fx_eval_sets(spark, sf_dir).where(F.col("model_starts").isNotNull())
    tp = fx.fx_responses(spark, sf_dir).select("filename", "total_pages")
    return s.select("filename", F.col("model_starts").alias("predicted_starts"), "gt_starts").join(tp, "filename")


def physical_pages(spark, sf_dir):
    return fx.fx_pages(spark, sf_dir).groupBy("filename").agg(F.max("total_pages").alias("n_pages"))


SEG_SQL = """sc AS (SELECT s.filename, s.model_starts AS predicted_starts, s.gt_starts, r.total_pages
  FROM fx_eval_sets s JOIN fx_responses r ON r.filename = s.filename WHERE s.model_starts IS NOT NULL),
phys AS (SELECT filename, max(total_pages) AS n_pages FROM fx_pages GROUP BY filename),
rp AS (SELECT sc.filename, sc.gt_starts, phys.n_pages IS NOT NULL AND phys.n_pages <> sc.total_pages AS page_count_changed,
  coalesce(phys.n_pages, sc.total_pages) AS total_pages,
  list_sort(list_distinct(list_concat([1], list_filter(sc.predicted_starts,
    lambda x: x >= 1 AND x <= coalesce(phys.n_pages, sc.total_pages))))) AS predicted_starts
  FROM sc LEFT JOIN phys ON phys.filename = sc.filename)"""


def reconciled(spark, sf_dir):
    return SE.reconcile_pages(seg_cands(spark, sf_dir), physical_pages(spark, sf_dir))


@query("reconcile_pages", f"""WITH {SEG_SQL}
SELECT filename, total_pages, array_to_string(predicted_starts, ',') AS starts_txt, page_count_changed FROM rp""")
def q_reconcile_pages(spark, sf_dir):
    r = reconciled(spark, sf_dir)
    return r.select("filename", "total_pages", array_text(F.col("predicted_starts")).alias("starts_txt"),
                    "page_count_changed")


def gt_docs(spark, sf_dir, rec):
    """Ground truth exists for packages whose order key is a multiple of four."""
    g = rec.where(F.split("filename", "_")[0].cast("bigint") % 4 == 0).select("filename", "total_pages", "gt_starts")
    return EV.build_ground_truth(g).select("filename", "documents")


SEGMENTS_SQL = f"""{SEG_SQL},
gtd AS (SELECT filename, total_pages, list_sort(list_distinct(list_concat([1], list_filter(gt_starts,
    lambda x: x >= 1 AND x <= total_pages)))) AS s FROM rp WHERE CAST(split_part(filename, '_', 1) AS BIGINT) % 4 = 0),
segs AS (
  SELECT filename, CAST(i AS INTEGER) AS doc_index, predicted_starts[i] - 1 AS from_page,
    coalesce(predicted_starts[i + 1] - 2, total_pages - 1) AS to_page, 'model' AS split_source
  FROM (SELECT *, generate_subscripts(predicted_starts, 1) AS i FROM rp) m
  WHERE filename NOT IN (SELECT filename FROM gtd)
  UNION ALL
  SELECT filename, CAST(i AS INTEGER), s[i] - 1, least(coalesce(s[i + 1] - 1, total_pages), total_pages) - 1, 'ground_truth'
  FROM (SELECT *, generate_subscripts(s, 1) AS i FROM gtd) g WHERE s[i] <= total_pages)"""


def segments_df(spark, sf_dir):
    rec = reconciled(spark, sf_dir)
    return SE.segments(rec, gt_docs(spark, sf_dir, rec), keys=("filename",))


@query("segments", f"""WITH {SEGMENTS_SQL}
SELECT filename, doc_index, from_page, to_page, printf('%s_%03d.pdf', filename, doc_index) AS out_name, split_source
FROM segs""")
def q_segments(spark, sf_dir):
    return segments_df(spark, sf_dir)


@query("split_summary", f"""WITH {SEGMENTS_SQL}
SELECT split_source, count(DISTINCT filename) AS n_packages, count(*) AS n_documents FROM segs GROUP BY split_source""")
def q_split_summary(spark, sf_dir):
    return SE.split_summary(segments_df(spark, sf_dir))


@query("page_documents", """SELECT p.filename, p.page_num, CAST(len(list_filter(e.gt_starts, lambda x: x <= p.page_num)) AS INTEGER)
  AS doc_index FROM fx_pages p JOIN fx_eval_sets e ON e.filename = p.filename""")
def q_page_documents(spark, sf_dir):
    pages = fx.fx_pages(spark, sf_dir).select("filename", "page_num")
    return SE.page_documents(pages, fx.fx_eval_sets(spark, sf_dir), "gt_starts")


ARCH_SQL = f"""{CAND_SQL},
arch AS (SELECT c.day_id, c.filename,
  CASE WHEN i.filename IS NOT NULL THEN 'moved' WHEN a.filename IS NOT NULL THEN 'already_archived' ELSE 'missing' END
    AS archive_state,
  CASE WHEN i.filename IS NOT NULL OR a.filename IS NOT NULL
       THEN concat('{ROOT}/archive/', c.day_id, '/', c.filename, '.pdf') END AS archived_path
  FROM (SELECT DISTINCT day_id, filename FROM cand) c
  LEFT JOIN (SELECT DISTINCT day_id, filename FROM fx_manifest WHERE volume = 'inbox') i
    ON i.day_id = c.day_id AND i.filename = c.filename
  LEFT JOIN (SELECT DISTINCT day_id, filename FROM fx_manifest WHERE volume = 'archive') a
    ON a.day_id = c.day_id AND a.filename = c.filename)"""


def archive_df(spark, sf_dir):
    return SE.archive_outcome(candidates(spark, sf_dir), fx.fx_manifest(spark, sf_dir), ROOT)


@query("archive_outcome", f"WITH {ARCH_SQL} SELECT * FROM arch")
def q_archive_outcome(spark, sf_dir):
    return archive_df(spark, sf_dir)


@query("apply_archive", f"""WITH {ARCH_SQL}
SELECT l.day_id, l.filename, l.log_seq, CASE WHEN a.archived_path IS NOT NULL THEN a.archived_path END AS archived_path,
  a.archived_path IS NOT NULL AS updated
FROM fx_log l LEFT JOIN arch a ON a.day_id = l.day_id AND a.filename = l.filename""")
def q_apply_archive(spark, sf_dir):
    out = SE.apply_archive(log_df(spark, sf_dir), archive_df(spark, sf_dir))
    return out.select("day_id", "filename", "log_seq", "archived_path", "updated")


@query("apply_split_outcome", f"""WITH {ARCH_SQL},
ok AS (SELECT c.day_id, c.filename, max(concat('{ROOT}/output/', c.day_id, '/', c.folder_id)) AS output_folder,
  max(c.total_pages) AS n_pages FROM cand c JOIN arch a ON a.day_id = c.day_id AND a.filename = c.filename
  WHERE a.archive_state <> 'missing' GROUP BY c.day_id, c.filename),
err AS (SELECT day_id, filename FROM arch WHERE archive_state = 'missing')
SELECT l.day_id, l.filename, l.log_seq,
  CASE WHEN e.day_id IS NOT NULL AND l.status = 'done' THEN 'error' ELSE l.status END AS status,
  CASE WHEN e.day_id IS NOT NULL AND l.status = 'done' THEN 'missing from both inbox and archive' ELSE l.error_message END
    AS error_message,
  CASE WHEN e.day_id IS NOT NULL AND l.status = 'done' THEN 'pdf_split' ELSE l.error_stage END AS error_stage,
  CASE WHEN o.day_id IS NOT NULL THEN 'pending' ELSE l.sftp_delivery_status END AS sftp_delivery_status,
  CASE WHEN o.day_id IS NOT NULL THEN o.output_folder END AS sftp_target_folder,
  CASE WHEN o.day_id IS NOT NULL THEN coalesce(o.n_pages, l.n_pages) ELSE l.n_pages END AS n_pages,
  CASE WHEN (e.day_id IS NOT NULL AND l.status = 'done') OR o.day_id IS NOT NULL THEN TIMESTAMP '{AS_OF_TEXT}'
       ELSE l.completed_at END AS completed_at,
  coalesce(e.day_id IS NOT NULL AND l.status = 'done', false) AS updated
FROM fx_log l LEFT JOIN ok o ON o.day_id = l.day_id AND o.filename = l.filename
LEFT JOIN err e ON e.day_id = l.day_id AND e.filename = l.filename""")
def q_apply_split_outcome(spark, sf_dir):
    cand = candidates(spark, sf_dir)
    arch = archive_df(spark, sf_dir)
    ok = cand.join(arch.where(F.col("archive_state") != "missing").select(*KEYS), list(KEYS)).select(
        *KEYS, F.concat(F.lit(f"{ROOT}/output/"), F.col("day_id"), F.lit("/"), F.col("folder_id")).alias("output_folder"),
        F.col("total_pages").alias("n_pages"))
    err = arch.where(F.col("archive_state") == "missing").select(
        *KEYS, F.lit("missing from both inbox and archive").alias("error"))
    out = SE.apply_split_outcome(log_df(spark, sf_dir), ok, err, as_of())
    return out.select("day_id", "filename", "log_seq", "status", "error_message", "error_stage",
                      "sftp_delivery_status", "sftp_target_folder", "n_pages", "completed_at", "updated")


# ---- delivery ---------------------------------------------------------------------------


@query("delivery_queue", f"""WITH {FILE_STATUS_CTES}
SELECT day_id, filename, folder_id FROM fs WHERE sftp_delivery_status = 'pending' AND status = 'done'""")
def q_delivery_queue(spark, sf_dir):
    return DL.delivery_queue(status_df(spark, sf_dir)).select("day_id", "filename", "folder_id")


def transfer_queue(spark, sf_dir):
    t = fx.fx_transfer(spark, sf_dir)
    # dealt by file at once: neither the distinct rows nor the join need another shuffle of them
    q = t.select("filename", "folder_id").repartition("filename").distinct().join(order_days(spark, sf_dir), "filename")
    return t, q


TASKS_SQL = f"""q AS (SELECT DISTINCT t.filename, t.folder_id, od.day_id FROM fx_transfer t JOIN {ORDER_DAY_SQL} od
  ON od.filename = t.filename),
rf AS (SELECT DISTINCT folder_id FROM fx_transfer WHERE remote_folder_exists),
tasks AS (SELECT q.filename, q.folder_id, q.day_id, l.out_name, l.local_size, l.upload_error,
  CASE WHEN l.out_name IS NULL THEN 'missing_local' WHEN rf.folder_id IS NULL THEN 'deferred' ELSE 'upload' END AS route,
  concat('{REMOTE_BASE}/', q.folder_id) AS remote_folder, concat('{REMOTE_BASE}/', q.folder_id, '/', l.out_name) AS remote_path
  FROM q LEFT JOIN fx_transfer l ON l.folder_id = q.folder_id AND regexp_extract(l.out_name, '^(.*)_\\d{{3,}}\\.pdf$', 1) = q.filename
  LEFT JOIN rf ON rf.folder_id = q.folder_id),
ver AS (SELECT tk.*, r.remote_size, r.remote_size IS NOT NULL AND r.remote_size = tk.local_size AS verified,
  CASE WHEN r.remote_size IS NULL THEN 'file not found on remote after upload'
       WHEN r.remote_size <> tk.local_size THEN concat('size mismatch: local=', CAST(tk.local_size AS STRING), 'B remote=',
         CAST(r.remote_size AS STRING), 'B') END AS issue
  FROM (SELECT * FROM tasks WHERE route = 'upload') tk LEFT JOIN
   (SELECT concat('{REMOTE_BASE}/', folder_id, '/', out_name) AS remote_path, remote_size FROM fx_transfer) r
   ON r.remote_path = tk.remote_path),
fc AS (SELECT folder_id, remote_folder, count(*) AS n_expected, count_if(remote_size IS NOT NULL) AS n_present,
  count(*) - count_if(remote_size IS NOT NULL) AS n_missing, count(*) - count_if(remote_size IS NOT NULL) = 0 AS complete
  FROM ver GROUP BY folder_id, remote_folder),
fo0 AS (SELECT v.day_id, v.filename, count(*) AS n_expected, count_if(v.verified AND coalesce(fc.complete, false) AND v.upload_error IS NULL) AS n_ok,
  arg_min(v.upload_error, CASE WHEN v.upload_error IS NOT NULL THEN v.out_name END) AS uerr,
  arg_min(v.issue, CASE WHEN v.issue IS NOT NULL THEN v.out_name END) AS vissue,
  arg_min(concat('folder incomplete: ', v.folder_id, ' missing ', CAST(fc.n_missing AS STRING), ' files'),
          CASE WHEN NOT coalesce(fc.complete, false) THEN v.out_name END) AS fissue,
  max(v.remote_folder) AS remote_folder
  FROM ver v LEFT JOIN fc ON fc.folder_id = v.folder_id GROUP BY v.day_id, v.filename),
fo AS (SELECT day_id, filename, n_expected, n_ok, remote_folder,
  CASE WHEN n_ok = n_expected THEN 'delivered' ELSE 'failed' END AS outcome,
  CASE WHEN n_ok <> n_expected THEN coalesce('upload error: ' || substr(uerr, 1, 300), 'verify failed: ' || substr(vissue, 1, 300), fissue) END AS fail_reason
  FROM fo0)"""


def tasks_df(spark, sf_dir):
    """The remote folders are written first: of a table whose size is known the planner sees whether it is small
    enough for a broadcast, and then the files need not be shuffled by folder."""
    t, q = transfer_queue(spark, sf_dir)
    rf = cut_lineage(fx.fx_remote_folders(spark, sf_dir))
    return DL.route_delivery(q, t.select("folder_id", "out_name", "local_size", "upload_error"), rf, REMOTE_BASE)


def settled_df(spark, sf_dir):
    """All routed files with their checks."""
    t = fx.fx_transfer(spark, sf_dir)
    remote = t.select(F.concat(F.lit(REMOTE_BASE + "/"), F.col("folder_id"), F.lit("/"), F.col("out_name"))
                      .alias("remote_path"), "remote_size")
    return DL.verify_sizes(tasks_df(spark, sf_dir), remote)


def verified_df(spark, sf_dir):
    return settled_df(spark, sf_dir).where(F.col("route") == "upload")


@query("route_delivery", f"""WITH {TASKS_SQL}
SELECT filename, folder_id, day_id, out_name, local_size, route, remote_folder, remote_path FROM tasks""")
def q_route_delivery(spark, sf_dir):
    return tasks_df(spark, sf_dir).select("filename", "folder_id", "day_id", "out_name", "local_size", "route",
                                          "remote_folder", "remote_path")


@query("verify_sizes", f"""WITH {TASKS_SQL}
SELECT filename, folder_id, out_name, local_size, remote_size, verified, issue FROM ver""")
def q_verify_sizes(spark, sf_dir):
    return verified_df(spark, sf_dir).select("filename", "folder_id", "out_name", "local_size", "remote_size",
                                             "verified", "issue")


@query("folder_completeness", f"WITH {TASKS_SQL} SELECT * FROM fc")
def q_folder_completeness(spark, sf_dir):
    return DL.folder_completeness(verified_df(spark, sf_dir))


def outcome_of(settled):
    """The folders' counts are written first, for the same reason as in ``tasks_df``."""
    v = settled.where(F.col("route") == "upload")
    return DL.file_outcome(v, cut_lineage(DL.folder_completeness(v)))


@query("file_outcome", f"""WITH {TASKS_SQL}
SELECT day_id, filename, n_expected, n_ok, outcome, fail_reason,
  CASE WHEN outcome = 'delivered' THEN 'delivered' WHEN fail_reason LIKE 'verify%' THEN 'verify_failed'
       WHEN fail_reason LIKE 'folder%' THEN 'folder_incomplete' WHEN fail_reason IS NOT NULL THEN 'error' END AS event_type
FROM fo""")
def q_file_outcome(spark, sf_dir):
    return outcome_of(cut_lineage(settled_df(spark, sf_dir))).select("day_id", "filename", "n_expected", "n_ok", "outcome", "fail_reason",
                                            "event_type")


@query("apply_delivery", f"""WITH {TASKS_SQL},
lg AS (SELECT DISTINCT day_id, filename, 'done' AS status, 'pending' AS sftp_delivery_status FROM q),
dfr AS (SELECT day_id, filename, max(concat('remote folder missing: {REMOTE_BASE}/', folder_id)) AS why FROM tasks
  WHERE route = 'deferred' GROUP BY day_id, filename)
SELECT lg.day_id, lg.filename,
  CASE WHEN f.outcome = 'failed' THEN 'failed' WHEN f.outcome = 'delivered' THEN 'delivered'
       WHEN d.filename IS NOT NULL THEN 'deferred' ELSE lg.sftp_delivery_status END AS sftp_delivery_status,
  CASE WHEN f.outcome = 'failed' THEN f.fail_reason WHEN f.outcome = 'delivered' THEN NULL
       WHEN d.filename IS NOT NULL THEN d.why END AS sftp_delivery_error,
  CASE WHEN f.outcome = 'delivered' THEN f.remote_folder END AS sftp_target_folder
FROM lg LEFT JOIN fo f ON f.day_id = lg.day_id AND f.filename = lg.filename
LEFT JOIN dfr d ON d.day_id = lg.day_id AND d.filename = lg.filename""")
def q_apply_delivery(spark, sf_dir):
    tasks = cut_lineage(settled_df(spark, sf_dir))  # routed and checked once, as in the job
    lg = tasks.select("day_id", "filename").distinct().select(
        "day_id", "filename", F.lit("done").alias("status"), F.lit("pending").alias("sftp_delivery_status"),
        F.lit(None).cast("string").alias("sftp_delivery_error"), F.lit(None).cast("string").alias("sftp_target_folder"),
        F.lit(None).cast("timestamp").alias("sftp_delivered_at"), F.lit(None).cast("string").alias("run_id"))
    deferred = tasks.where(F.col("route") == "deferred").groupBy(*KEYS).agg(F.max("folder_id").alias("folder_id"))
    out = DL.apply_delivery(lg, outcome_of(tasks), deferred, REMOTE_BASE, as_of())
    return out.select("day_id", "filename", "sftp_delivery_status", "sftp_delivery_error", "sftp_target_folder")


# ---- sampling and export --------------------------------------------------------------

SAMPLE_SQL = """files AS (SELECT DISTINCT day_id, filename FROM fx_split),
sranked AS (SELECT *, md5(concat('check-sample-', day_id, ':', filename)) AS sample_key,
  row_number() OVER (PARTITION BY day_id ORDER BY md5(concat('check-sample-', day_id, ':', filename)), filename) AS rn,
  count(*) OVER (PARTITION BY day_id) AS n FROM files),
smp AS (SELECT day_id, filename, sample_key FROM sranked
  WHERE rn <= greatest(1, (n * 10) // 100 + CASE WHEN 2 * ((n * 10) % 100) > 100
    OR (2 * ((n * 10) % 100) = 100 AND ((n * 10) // 100) % 2 = 1) THEN 1 ELSE 0 END))"""


def sample_df(spark, sf_dir):
    return SM.annotation_sample(fx.fx_split(spark, sf_dir), 10)


@query("annotation_sample", f"WITH {SAMPLE_SQL} SELECT * FROM smp")
def q_annotation_sample(spark, sf_dir):
    return sample_df(spark, sf_dir)


@query("export_predictions", f"""WITH {FILE_STATUS_CTES}, {SAMPLE_SQL},
pend AS (SELECT * FROM smp s WHERE NOT EXISTS (SELECT 1 FROM fx_manifest g WHERE g.volume = 'ground_truth'
  AND g.day_id = s.day_id AND g.filename = s.filename))
SELECT p.day_id, p.filename, l.total_pages IS NOT NULL AS has_prediction,
  CAST(CASE WHEN l.total_pages IS NULL
       THEN json_object('filename', p.filename, 'day_id', p.day_id, 'note', 'not_yet_processed', 'predicted_starts', NULL)
       ELSE json_object('filename', p.filename, 'folder_id', l.folder_id, 'day_id', p.day_id, 'total_pages', l.total_pages,
         'n_documents', l.n_documents, 'predicted_starts', [1, l.n_documents + 1],
         'model_used', CASE WHEN l.boundary_source <> 'ultimate_fallback' THEN 'model-' || l.boundary_source END,
         'fallback_used', l.boundary_source = 'fallback', 'verification_applied', true, 'needs_review', l.needs_review,
         'boundary_source', l.boundary_source, 'processed_at', strftime(l.processing_timestamp, '%Y-%m-%d %H:%M:%S')) END AS VARCHAR) AS record
FROM pend p LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY day_id, filename
  ORDER BY processing_timestamp DESC, split_seq DESC) AS nth FROM fx_split) WHERE nth = 1) l
  ON l.day_id = p.day_id AND l.filename = p.filename""")
def q_export_predictions(spark, sf_dir):
    man = fx.fx_manifest(spark, sf_dir)
    pend = sample_df(spark, sf_dir).join(man.where(F.col("volume") == "ground_truth").select(*KEYS), list(KEYS),
                                         "left_anti")
    source = F.col("boundary_source")
    split = V.latest_split(fx.fx_split(spark, sf_dir)).withColumns({
        "predicted_starts": F.array(F.lit(1), F.col("n_documents") + 1),
        "model_used": F.when(source != "ultimate_fallback", F.concat(F.lit("model-"), source)),
        "fallback_used": source == "fallback", "verification_applied": F.lit(True)})
    return SM.export_predictions(pend, split).select("day_id", "filename", "has_prediction", "record")


@query("flow_counters", f"""WITH {FILE_STATUS_CTES},
f AS (SELECT day_id, count_if(status = 'parsed') AS n_parsed, count_if(status = 'done') AS n_predicted,
  count_if(status = 'error') AS n_error, count_if(needs_review) AS n_needs_review,
  count_if(sftp_delivery_status = 'pending') AS n_sftp_pending, count_if(sftp_delivery_status = 'delivered') AS n_delivered,
  count_if(sftp_delivery_status = 'failed') AS n_sftp_failed, count_if(sftp_delivery_status = 'deferred') AS n_deferred
  FROM fs GROUP BY day_id),
v AS (SELECT day_id, count_if(volume = 'inbox') AS n_inbox FROM fx_manifest GROUP BY day_id),
wl AS (SELECT s.day_id, s.filename, g.filename IS NOT NULL AS annotated FROM (SELECT * FROM fx_manifest WHERE volume = 'validation') s
  LEFT JOIN (SELECT DISTINCT day_id, filename FROM fx_manifest WHERE volume = 'ground_truth') g
  ON g.day_id = s.day_id AND g.filename = s.filename),
gs AS (SELECT day_id, count(*) AS n_sampled, count_if(annotated) AS n_annotated FROM wl GROUP BY day_id)
SELECT f.day_id, coalesce(v.n_inbox, 0) AS inbox, n_parsed + n_predicted AS parsed, n_predicted AS predicted,
  coalesce(gs.n_annotated, 0) AS gate, n_sftp_pending + n_delivered + n_sftp_failed + n_deferred AS split,
  n_delivered AS delivered, n_error AS parsed_errors, n_needs_review AS predicted_errors,
  coalesce(gs.n_sampled, 0) - coalesce(gs.n_annotated, 0) AS gate_errors, n_deferred AS split_errors,
  n_sftp_failed AS delivered_errors
FROM f LEFT JOIN v ON v.day_id = f.day_id LEFT JOIN gs ON gs.day_id = f.day_id""")
def q_flow_counters(spark, sf_dir):
    man = fx.fx_manifest(spark, sf_dir)
    vols = V.volume_counts(man)
    gate = EV.gate_state(man.where(F.col("volume") == "validation"), man.where(F.col("volume") == "ground_truth"))
    return V.flow_counters(funnel_df(spark, sf_dir), vols, gate)
