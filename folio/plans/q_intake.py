"""Intake and state-update queries (INT1-16, UPD1-9, BND14, SNK2)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.common import KEYS, to_bool, to_float, to_int, valid_name
from folio.operators import evaluation as EV
from folio.operators import intake as IN
from folio.operators import state as ST
from folio.operators import views as V
from folio.plans import fixtures as fx
from folio.plans.q_views import AS_OF_TEXT, BATCH_STATUS_CTES, FILE_STATUS_CTES, as_of, status_df
from folio.plans.registry import query
from folio.schemas import PROCESSING_LOG
from folio.sources.files import batch, params_df

ROOT = "/data/docs"


def log_df(spark, sf_dir):
    """fx_log with every processing_log column (absent ones as typed NULLs)."""
    lg = fx.fx_log(spark, sf_dir)
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in PROCESSING_LOG.fields if f.name not in lg.columns]
    return lg.select("*", *missing)


def inbox_df(spark, sf_dir):
    """Inbox listing: one PDF per (batch, package) with its largest logged size."""
    lg = fx.fx_log(spark, sf_dir).groupBy("day_id", "filename").agg(F.max("length_bytes").alias("length"))
    return lg.select("day_id", F.concat(F.lit(f"{ROOT}/inbox/"), F.col("day_id"), F.lit("/"), F.col("filename"),
                                        F.lit(".pdf")).alias("path"), "length")


INBOX_SQL = f"""inbox AS (SELECT day_id, concat('{ROOT}/inbox/', day_id, '/', filename, '.pdf') AS path,
  max(length_bytes) AS length FROM fx_log GROUP BY day_id, filename),
ik AS (SELECT *, regexp_extract(path, '([^/]+)\\.pdf$', 1) AS filename FROM inbox),
ikeys AS (SELECT *, regexp_extract(filename, '^([A-Za-z0-9]+)_', 1) AS folder_id, round(length / 1048576.0, 2) AS file_size_mb,
  CASE WHEN length > 100 * 1048576 THEN 'oversized' WHEN length > 74 * 1048576 THEN 'large' ELSE 'standard' END
    AS size_category FROM ik)"""


def keyed_inbox(spark, sf_dir):
    return IN.classify_size(IN.path_keys(inbox_df(spark, sf_dir)))


@query("path_keys", f"WITH {INBOX_SQL} SELECT day_id, path, filename, folder_id FROM ikeys")
def q_path_keys(spark, sf_dir):
    return IN.path_keys(inbox_df(spark, sf_dir)).select("day_id", "path", "filename", "folder_id")


@query("classify_size", f"WITH {INBOX_SQL} SELECT day_id, filename, length, file_size_mb, size_category FROM ikeys")
def q_classify_size(spark, sf_dir):
    return keyed_inbox(spark, sf_dir).select("day_id", "filename", "length", "file_size_mb", "size_category")


@query("size_class_counts", f"WITH {INBOX_SQL} SELECT size_category, count(*) AS n_files FROM ikeys GROUP BY size_category")
def q_size_class_counts(spark, sf_dir):
    return IN.size_class_counts(keyed_inbox(spark, sf_dir))


@query("valid_name", """SELECT event_id,
  regexp_matches(filename, '^[A-Za-z0-9._-]+$') AND NOT contains(filename, '..') AS filename_ok,
  regexp_matches(props, '^[A-Za-z0-9._-]+$') AND NOT contains(props, '..') AS props_ok,
  regexp_matches(concat(filename, '..x'), '^[A-Za-z0-9._-]+$') AND NOT contains(concat(filename, '..x'), '..') AS dotted_ok
FROM (SELECT CAST(event_id AS STRING) AS event_id, concat(CAST(user_id AS STRING), '_PKG') AS filename, props FROM events) e""")
def q_valid_name(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("_PKG")).alias("filename"), "props")
    return e.select("event_id", valid_name(F.col("filename")).alias("filename_ok"),
                    valid_name(F.col("props")).alias("props_ok"),
                    valid_name(F.concat("filename", F.lit("..x"))).alias("dotted_ok"))


@query("register", f"""WITH {INBOX_SQL}
SELECT day_id, filename, folder_id, file_size_mb, CASE WHEN size_category = 'oversized' THEN 'skipped' ELSE 'pending' END AS status,
  CASE WHEN size_category = 'oversized' THEN 'File exceeds 100MB limit' END AS error_message, 0 AS retry_count,
  TIMESTAMP '{AS_OF_TEXT}' AS created_at, 'run-1' AS run_id
FROM ikeys k WHERE NOT EXISTS (SELECT 1 FROM fx_split s WHERE s.day_id = k.day_id AND s.filename = k.filename)
  AND NOT EXISTS (SELECT 1 FROM fx_log l WHERE l.day_id = k.day_id AND CASE WHEN l.retry_count >= 1 THEN l.filename ELSE l.filename || '_0' END = k.filename)""")
def q_register(spark, sf_dir):
    # files of first attempts are logged under another name, so their registration finds nothing
    log = fx.fx_log(spark, sf_dir).withColumn("filename", F.when(F.col("retry_count") >= 1, F.col("filename"))
                                              .otherwise(F.concat("filename", F.lit("_0"))))
    r = IN.register(keyed_inbox(spark, sf_dir), fx.fx_split(spark, sf_dir), log, "run-1", as_of())
    return r.select("day_id", "filename", "folder_id", "file_size_mb", "status", "error_message", "retry_count",
                    "created_at", "run_id")


@query("parse_queue", f"""WITH {INBOX_SQL},
todo AS (SELECT * FROM ikeys k WHERE length <= 100 * 1048576
  AND NOT EXISTS (SELECT 1 FROM fx_split s WHERE s.day_id = k.day_id AND s.filename = k.filename)),
g AS (SELECT *, CASE WHEN length <= 74 * 1048576 THEN 'parallel' ELSE 'sequential' END AS queue FROM todo),
r AS (SELECT *, row_number() OVER (PARTITION BY day_id, queue ORDER BY substr(md5(filename), 1, 3), filename) AS rn FROM g)
SELECT day_id, filename, length, queue,
  CAST(CASE WHEN queue = 'parallel' THEN ceil(rn / 100.0) END AS INTEGER) AS chunk,
  CAST(CASE WHEN queue = 'sequential' THEN rn END AS INTEGER) AS sequence FROM r""")
def q_parse_queue(spark, sf_dir):
    q = IN.parse_queue(keyed_inbox(spark, sf_dir), fx.fx_split(spark, sf_dir))
    return q.select("day_id", "filename", "length", "queue", "chunk", "sequence")


_BIN_BYTES = 2_000 * IN.MB


@query("byte_bins", f"""WITH {INBOX_SQL},
todo AS (SELECT * FROM ikeys k WHERE length <= 100 * 1048576
  AND NOT EXISTS (SELECT 1 FROM fx_split s WHERE s.day_id = k.day_id AND s.filename = k.filename)),
t AS (SELECT day_id, filename, length, sum(length) OVER (PARTITION BY day_id) AS total,
        coalesce(sum(length) OVER (PARTITION BY day_id ORDER BY substr(md5(filename), 1, 3), filename, length
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM todo),
w AS (SELECT *, greatest(1, (total + {_BIN_BYTES - 1}) // {_BIN_BYTES}) AS bins FROM t)
SELECT day_id, filename, length, CAST(least(before // greatest(1, (total + bins - 1) // bins), bins - 1) AS INTEGER) AS bin FROM w""")
def q_byte_bins(spark, sf_dir):
    q = IN.byte_bins(IN.parse_queue(keyed_inbox(spark, sf_dir), fx.fx_split(spark, sf_dir)), _BIN_BYTES)
    return q.select("day_id", "filename", "length", "bin")


@query("flag_null_pages", f"""SELECT day_id, filename, 'parse' AS stage, 'needs_review' AS event_type, '{IN.NULL_PAGES_DETAIL}' AS detail
FROM fx_split WHERE split_seq % 9 = 0""")
def q_flag_null_pages(spark, sf_dir):
    parsed = fx.fx_split(spark, sf_dir).select(*KEYS, F.when(F.col("split_seq") % 9 != 0, F.col("total_pages")).alias("n_pages"))
    return IN.flag_null_pages(parsed, as_of()).select("day_id", "filename", "stage", "event_type", "detail")


@query("batch_scan", "SELECT day_id, filename, log_seq, status FROM fx_log WHERE day_id = '199806'")
def q_batch_scan(spark, sf_dir):
    return batch(fx.fx_log(spark, sf_dir), "199806").select("day_id", "filename", "log_seq", "status")


@query("params_join", """SELECT l.day_id, l.filename, l.log_seq, p.label FROM fx_log l
JOIN (VALUES ('error', 'look'), ('deferred''; --', 'none'), ('done', 'fine')) p(status, label) ON p.status = l.status""")
def q_params_join(spark, sf_dir):
    rows = [("error", "look"), ("deferred'; --", "none"), ("done", "fine")]
    names = params_df(spark, rows, T.StructType([T.StructField("status", T.StringType()), T.StructField("label", T.StringType())]))
    return fx.fx_log(spark, sf_dir).join(names, "status").select("day_id", "filename", "log_seq", "label")


@query("typed_casts", """WITH v AS (SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN ' ' || o_custkey || ' ' WHEN 1 THEN ''
  WHEN 2 THEN 'x' || o_custkey WHEN 3 THEN CAST(o_totalprice AS VARCHAR) WHEN 4 THEN ' TRUE' END AS txt FROM orders)
SELECT k, CASE WHEN regexp_full_match(trim(txt), '[0-9]+') THEN CAST(trim(txt) AS INTEGER) END AS as_int,
  CASE WHEN k % 6 IN (0, 3) THEN CAST(trim(txt) AS DOUBLE) END AS as_float, lower(trim(txt)) = 'true' AS as_bool FROM v""")
def q_typed_casts(spark, sf_dir):
    k = F.col("o_orderkey")
    txt = (F.when(k % 6 == 0, F.concat(F.lit(" "), F.col("o_custkey"), F.lit(" "))).when(k % 6 == 1, F.lit(""))
           .when(k % 6 == 2, F.concat(F.lit("x"), F.col("o_custkey"))).when(k % 6 == 3, F.format_string("%.2f", F.col("o_totalprice").cast("double")))
           .when(k % 6 == 4, F.lit(" TRUE")))
    v = fx.table(spark, sf_dir, "orders").select(k.alias("k"), txt.alias("txt"))
    return v.select("k", to_int(F.col("txt")).alias("as_int"), to_float(F.col("txt")).alias("as_float"), to_bool(F.col("txt")).alias("as_bool"))


@query("retry_split_artifacts", f"""WITH {FILE_STATUS_CTES},
t AS (SELECT DISTINCT day_id, filename FROM fs WHERE status = 'error' AND error_stage = 'pdf_split')
SELECT s.day_id, s.filename, s.split_seq FROM fx_split s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.day_id = s.day_id AND t.filename = s.filename)""")
def q_retry_split_artifacts(spark, sf_dir):
    return ST.drop_artifacts(fx.fx_split(spark, sf_dir), _eligible(spark, sf_dir, "retry-split")).select("day_id", "filename", "split_seq")


@query("quarantine_plan", f"""SELECT DISTINCT day_id, filename, concat('{ROOT}/inbox/', day_id, '/', filename, '.pdf') AS src,
  concat('{ROOT}/quarantine/', day_id, '/', filename, '.pdf') AS dst, 'parse failed after 2 retries' AS reason
FROM fx_log WHERE status = 'error' AND error_stage = 'parsing' AND retry_count >= 2""")
def q_quarantine_plan(spark, sf_dir):
    return IN.quarantine_plan(fx.fx_log(spark, sf_dir), ROOT)


@query("disposition_plan", f"""SELECT DISTINCT day_id, filename, concat('{ROOT}/inbox/', day_id, '/', filename, '.pdf') AS src,
  concat('{ROOT}/oversized/', day_id, '/', filename, '.pdf') AS dst, 'oversized' AS reason FROM fx_log WHERE status = 'skipped'
UNION ALL SELECT DISTINCT day_id, filename, concat('{ROOT}/inbox/', day_id, '/', filename, '.pdf'),
  concat('{ROOT}/quarantine/', day_id, '/', filename, '.pdf'), 'parse failed after 2 retries'
  FROM fx_log WHERE status = 'error' AND error_stage = 'parsing' AND retry_count >= 2
UNION ALL SELECT DISTINCT day_id, filename, concat('{ROOT}/inbox/', day_id, '/', filename, '.pdf'),
  concat('{ROOT}/archive/', day_id, '/', filename, '.pdf'), 'split'
  FROM fx_log WHERE status = 'done' AND sftp_delivery_status IN ('pending', 'delivered')""")
def q_disposition_plan(spark, sf_dir):
    return IN.disposition_plan(fx.fx_log(spark, sf_dir), ROOT)


@query("run_outcome", """SELECT day_id, count(*) AS total, CAST(count_if(status = 'parsed') AS BIGINT) AS parsed,
  CAST(count_if(status = 'done') AS BIGINT) AS done, CAST(count_if(status = 'skipped') AS BIGINT) AS skipped,
  CAST(count_if(status = 'error') AS BIGINT) AS errored,
  CASE WHEN count_if(status = 'error') > 0 AND count_if(status = 'parsed') > 0 THEN 'partial_failure'
       WHEN count_if(status = 'error') > 0 THEN 'failed' ELSE 'success' END AS run_status,
  CASE WHEN count_if(status = 'error') = 0 THEN 'success' ELSE 'partial_failure' END AS split_run_status
FROM fx_log GROUP BY day_id""")
def q_run_outcome(spark, sf_dir):
    lg = fx.fx_log(spark, sf_dir)
    parse = IN.run_outcome(lg, "parse")
    split = IN.run_outcome(lg, "split").select("day_id", F.col("run_status").alias("split_run_status"))
    return parse.join(split, "day_id")


@query("batch_outcome", f"""WITH {FILE_STATUS_CTES},
c AS (SELECT fs.day_id, coalesce(max(m.n_inbox), 0) AS n_inbox, count_if(status = 'pending') AS n_to_parse,
    count_if(status = 'skipped') AS n_oversized_new, count_if(status = 'parsed') AS n_to_split,
    count_if(split_seq IS NOT NULL) AS n_split_results, coalesce(max(m.n_validation), 0) AS n_validation,
    coalesce(max(m.n_unannotated), 0) AS n_unannotated, count_if(sftp_delivery_status = 'pending') AS n_pending,
    count_if(sftp_delivery_status = 'pending' AND status = 'done') AS n_routable
  FROM fs LEFT JOIN (SELECT day_id, count_if(volume = 'inbox') AS n_inbox, count_if(volume = 'validation') AS n_validation,
      count_if(volume = 'validation' AND NOT EXISTS (SELECT 1 FROM fx_manifest g WHERE g.volume = 'ground_truth'
        AND g.day_id = v.day_id AND g.filename = v.filename)) AS n_unannotated FROM fx_manifest v GROUP BY day_id) m
    ON m.day_id = fs.day_id GROUP BY fs.day_id)
SELECT day_id,
  CASE WHEN n_inbox = 0 THEN 'NO_FILES' WHEN n_to_parse = 0 AND n_oversized_new = 0 THEN 'ALL_ALREADY_PARSED' END AS parse_outcome,
  CASE WHEN n_to_split = 0 THEN 'NO_FILES_TO_SPLIT' END AS split_outcome,
  CASE WHEN n_split_results = 0 THEN 'NO_SPLIT_RESULTS' WHEN n_validation = 0 THEN 'NO_FILES_IN_VALIDATION'
       WHEN n_unannotated = 0 THEN 'ALL_ANNOTATED' END AS export_outcome,
  CASE WHEN n_pending = 0 THEN 'NO_FILES_PENDING' WHEN n_routable = 0 THEN 'ALL_DEFERRED' END AS delivery_outcome
FROM c""")
def q_batch_outcome(spark, sf_dir):
    st = status_df(spark, sf_dir)
    man = fx.fx_manifest(spark, sf_dir)
    wl = EV.worklist(man.where(F.col("volume") == "validation"), man.where(F.col("volume") == "ground_truth"))
    vols = (man.groupBy("day_id").agg(F.sum(F.when(F.col("volume") == "inbox", 1).otherwise(0)).alias("n_inbox"))
            .join(wl.groupBy("day_id").agg(F.count(F.lit(1)).alias("n_validation"),
                                           F.sum(F.when(~F.col("annotated"), 1).otherwise(0)).alias("n_unannotated")),
                  "day_id", "left"))
    s, sf = F.col("status"), F.col("sftp_delivery_status")

    def cnt(c):
        return F.sum(F.when(c, 1).otherwise(0))

    c = st.groupBy("day_id").agg(
        cnt(s == "pending").alias("n_to_parse"), cnt(s == "skipped").alias("n_oversized_new"),
        cnt(s == "parsed").alias("n_to_split"), cnt(F.col("split_seq").isNotNull()).alias("n_split_results"),
        cnt(sf == "pending").alias("n_pending"), cnt((sf == "pending") & (s == "done")).alias("n_routable"))
    c = c.join(vols, "day_id", "left").fillna(0, ["n_inbox", "n_validation", "n_unannotated"])
    return IN.batch_outcome(c)


# ---- guarded updates -----------------------------------------------------------------

UPDATE_COLS = ["day_id", "filename", "log_seq", "status", "error_message", "error_stage", "retry_count",
               "sftp_delivery_status", "n_pages", "completed_at", "updated"]


def _upd_sql(targets: str, sets: dict[str, str], guard: str = "true", base: str = "fx_log") -> str:
    hit = f"(t.day_id IS NOT NULL AND ({guard}))"
    cols = []
    for c in ["status", "error_message", "error_stage", "retry_count", "sftp_delivery_status", "n_pages", "completed_at"]:
        cols.append(f"CASE WHEN {hit} THEN {sets[c]} ELSE l.{c} END AS {c}" if c in sets else f"l.{c}")
    return f"""SELECT l.day_id, l.filename, l.log_seq, {", ".join(cols)}, coalesce({hit}, false) AS updated
FROM {base} l LEFT JOIN (SELECT DISTINCT day_id, filename FROM ({targets}) tt) t
  ON t.day_id = l.day_id AND t.filename = l.filename"""


def _eligible(spark, sf_dir, action):
    stuck = V.stuck_files(status_df(spark, sf_dir), as_of())
    el = ST.eligible_actions(stuck)
    return el.where(F.array_contains("actions", action)).select(*KEYS)


def _upd_out(df):
    return df.select(*UPDATE_COLS)


STUCK_CTE = f"""{FILE_STATUS_CTES}"""


@query("retry_parse", f"""WITH {STUCK_CTE}
{_upd_sql("SELECT day_id, filename FROM fs WHERE status = 'error' AND error_stage = 'parsing'",
          {"status": "'pending'", "error_message": "NULL", "error_stage": "NULL", "retry_count": "l.retry_count + 1"},
          "l.status = 'error'")}""")
def q_retry_parse(spark, sf_dir):
    return _upd_out(ST.retry_parse(log_df(spark, sf_dir), _eligible(spark, sf_dir, "retry-parse")))


@query("retry_split", f"""WITH {STUCK_CTE}
{_upd_sql("SELECT day_id, filename FROM fs WHERE status = 'error' AND error_stage = 'pdf_split'",
          {"status": "'parsed'", "error_message": "NULL", "error_stage": "NULL"}, "l.status IN ('done', 'error')")}""")
def q_retry_split(spark, sf_dir):
    return _upd_out(ST.retry_split(log_df(spark, sf_dir), _eligible(spark, sf_dir, "retry-split")))


@query("retry_sftp", f"""WITH {STUCK_CTE}
{_upd_sql("SELECT day_id, filename FROM fs WHERE sftp_delivery_status IN ('failed', 'deferred')",
          {"sftp_delivery_status": "'pending'"}, "l.sftp_delivery_status IN ('failed', 'deferred')")}""")
def q_retry_sftp(spark, sf_dir):
    return _upd_out(ST.retry_sftp(log_df(spark, sf_dir), _eligible(spark, sf_dir, "retry-sftp")))


@query("mark_manual", f"""WITH {STUCK_CTE}, c AS (SELECT TIMESTAMP '{AS_OF_TEXT}' AS as_of)
{_upd_sql("SELECT day_id, filename FROM fs, c WHERE status = 'parsing' AND created_at < as_of - INTERVAL 2 HOURS",
          {"status": "'manual'"})}""")
def q_mark_manual(spark, sf_dir):
    stuck = V.stuck_files(status_df(spark, sf_dir), as_of())
    t = stuck.where(F.col("stuck_reason") == "stuck in parsing > 2h").select(*KEYS)
    return _upd_out(ST.mark_manual(log_df(spark, sf_dir), t))


@query("reset_deferred", _upd_sql("SELECT day_id, filename FROM fx_log WHERE day_id = '199806'",
                                  {"sftp_delivery_status": "'pending'"},
                                  "l.sftp_delivery_status = 'deferred' AND l.day_id = '199806'"))
def q_reset_deferred(spark, sf_dir):
    return _upd_out(ST.reset_deferred(log_df(spark, sf_dir), "199806"))


@query("mark_parsed", f"""WITH p AS (SELECT day_id, filename, max(total_pages) AS n_pages FROM fx_split GROUP BY day_id, filename)
SELECT l.day_id, l.filename, l.log_seq,
  CASE WHEN p.day_id IS NOT NULL AND l.status IN ('pending', 'parsing') THEN 'parsed' ELSE l.status END AS status,
  l.error_message, l.error_stage, l.retry_count, l.sftp_delivery_status,
  CASE WHEN p.day_id IS NOT NULL AND l.status IN ('pending', 'parsing') THEN p.n_pages ELSE l.n_pages END AS n_pages,
  CASE WHEN p.day_id IS NOT NULL AND l.status IN ('pending', 'parsing') THEN TIMESTAMP '{AS_OF_TEXT}' ELSE l.completed_at END
    AS completed_at,
  p.day_id IS NOT NULL AND l.status IN ('pending', 'parsing') AS updated
FROM fx_log l LEFT JOIN p ON p.day_id = l.day_id AND p.filename = l.filename""")
def q_mark_parsed(spark, sf_dir):
    parsed = fx.fx_split(spark, sf_dir).select(*KEYS, F.col("total_pages").alias("n_pages"))
    return _upd_out(ST.mark_parsed(log_df(spark, sf_dir), parsed, "run-1", as_of()))


@query("reconcile_stuck", f"""SELECT day_id, filename, log_seq,
  CASE WHEN status = 'parsing' THEN 'error' ELSE status END AS status,
  CASE WHEN status = 'parsing' THEN 'stranded in parsing at end of run — see pipeline_events' ELSE error_message END AS error_message,
  CASE WHEN status = 'parsing' THEN 'parsing' ELSE error_stage END AS error_stage, retry_count, sftp_delivery_status, n_pages,
  CASE WHEN status = 'parsing' THEN TIMESTAMP '{AS_OF_TEXT}' ELSE completed_at END AS completed_at,
  status = 'parsing' AS updated FROM fx_log""")
def q_reconcile_stuck(spark, sf_dir):
    return _upd_out(ST.reconcile_stuck(log_df(spark, sf_dir), "run-1", as_of()))


@query("reconcile_events", f"""SELECT DISTINCT day_id, filename, 'parse' AS stage, 'error' AS event_type, 'parsing' AS old_status,
  'error' AS new_status, 'stranded in parsing at end of run' AS error_message, 'pipeline' AS actor,
  TIMESTAMP '{AS_OF_TEXT}' AS event_ts FROM fx_log WHERE status = 'parsing'""")
def q_reconcile_events(spark, sf_dir):
    e = IN.reconcile_events(fx.fx_log(spark, sf_dir), as_of())
    return e.select("day_id", "filename", "stage", "event_type", "old_status", "new_status", "error_message", "actor",
                    "event_ts")


@query("approve_review", """SELECT s.day_id, s.filename, s.split_seq,
  CASE WHEN t.day_id IS NOT NULL THEN false ELSE s.needs_review END AS needs_review, t.day_id IS NOT NULL AS updated
FROM fx_split s LEFT JOIN (SELECT DISTINCT day_id, filename FROM fx_split WHERE needs_review AND boundary_source = 'ultimate_fallback'
  AND substr(day_id, 1, 4) = '1996') t ON t.day_id = s.day_id AND t.filename = s.filename""")
def q_approve_review(spark, sf_dir):
    split = fx.fx_split(spark, sf_dir)
    targets = V.needs_review(split).where(F.substring("day_id", 1, 4) == "1996").select(*KEYS)
    return ST.approve_review(split, targets).select("day_id", "filename", "split_seq", "needs_review", "updated")


@query("mark_done", f"""WITH fin AS (SELECT day_id, filename, n_documents FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY day_id,
  filename ORDER BY processing_timestamp DESC, split_seq DESC) AS rn FROM fx_split) t WHERE rn = 1)
SELECT l.day_id, l.filename, l.log_seq,
  CASE WHEN f.day_id IS NOT NULL AND l.status = 'parsed' THEN 'done' ELSE l.status END AS status,
  CASE WHEN f.day_id IS NOT NULL AND l.status = 'parsed' THEN f.n_documents END AS n_documents_found,
  f.day_id IS NOT NULL AND l.status = 'parsed' AS updated
FROM fx_log l LEFT JOIN fin f ON f.day_id = l.day_id AND f.filename = l.filename""")
def q_mark_done(spark, sf_dir):
    fin = V.latest_split(fx.fx_split(spark, sf_dir)).select(
        *KEYS, F.array_repeat(F.lit(1), F.col("n_documents")).alias("predicted_starts"))
    out = ST.mark_done(log_df(spark, sf_dir), fin, "run-1", as_of())
    return out.select("day_id", "filename", "log_seq", "status", "n_documents_found", "updated")


@query("action_events", f"""WITH {STUCK_CTE},
t AS (SELECT DISTINCT day_id, filename FROM fs WHERE status = 'error' AND error_stage = 'parsing'),
e AS (SELECT CAST(NULL AS VARCHAR) AS run_id, day_id, 'dashboard' AS stage, 'requeued' AS event_type, filename,
  CAST(NULL AS VARCHAR) AS folder_id, CAST(NULL AS VARCHAR) AS old_status, CAST(NULL AS VARCHAR) AS new_status,
  'retry parse: error → pending' AS detail, CAST(NULL AS VARCHAR) AS error_message, 'ops@example.org' AS actor,
  TIMESTAMP '{AS_OF_TEXT}' AS event_ts FROM t)
SELECT substr(sha256(concat_ws('|', coalesce(run_id, ''), coalesce(day_id, ''), stage, event_type, coalesce(filename, ''),
  coalesce(folder_id, ''), coalesce(old_status, ''), coalesce(new_status, ''), coalesce(detail, ''),
  coalesce(error_message, ''), actor, CAST(event_ts AS VARCHAR))), 1, 32) AS event_id, * FROM e""")
def q_action_events(spark, sf_dir):
    t = _eligible(spark, sf_dir, "retry-parse").distinct()
    return ST.action_events(t, "retry-parse", "ops@example.org", as_of())


@query("eligible_actions", f"""WITH {STUCK_CTE}, c AS (SELECT TIMESTAMP '{AS_OF_TEXT}' AS as_of)
SELECT day_id, filename, array_to_string(list_filter([
  CASE WHEN status = 'error' AND error_stage = 'parsing' THEN 'retry-parse' END,
  CASE WHEN status = 'error' AND error_stage = 'pdf_split' THEN 'retry-split' END,
  CASE WHEN sftp_delivery_status IN ('failed', 'deferred') THEN 'retry-sftp' END,
  CASE WHEN coalesce(needs_review, false) THEN 'approve-review' END, 'mark-manual'], lambda x: x IS NOT NULL), ',') AS actions
FROM fs, c WHERE status = 'error' OR sftp_delivery_status IN ('failed', 'deferred')
   OR (status = 'parsing' AND created_at < as_of - INTERVAL 2 HOURS)
   OR (status = 'parsed' AND completed_at < as_of - INTERVAL 12 HOURS)
   OR (sftp_delivery_status = 'pending' AND completed_at < as_of - INTERVAL 24 HOURS)
   OR (needs_review AND sftp_delivery_status IS NULL)""")
def q_eligible_actions(spark, sf_dir):
    el = ST.eligible_actions(V.stuck_files(status_df(spark, sf_dir), as_of()))
    return el.select("day_id", "filename", F.array_join("actions", ",").alias("actions"))


@query("replace_files", """WITH new AS (SELECT * FROM fx_split WHERE boundary_source = 'chunked')
SELECT day_id, filename, count(*) AS n_rows, max(split_seq) AS max_seq FROM (
  SELECT s.* FROM fx_split s WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.day_id = s.day_id AND n.filename = s.filename)
  UNION ALL SELECT * FROM new) u GROUP BY day_id, filename""")
def q_replace_files(spark, sf_dir):
    split = fx.fx_split(spark, sf_dir)
    new = split.where(F.col("boundary_source") == "chunked")
    r = ST.replace_files(split, new)
    return r.groupBy("day_id", "filename").agg(F.count(F.lit(1)).alias("n_rows"), F.max("split_seq").alias("max_seq"))


@query("batch_actions", f"""WITH {BATCH_STATUS_CTES},
inb AS (SELECT day_id, count(*) AS n_inbox FROM fx_manifest WHERE volume = 'inbox' GROUP BY day_id)
SELECT bs.day_id, bs.lifecycle, array_to_string(list_filter([
  CASE WHEN bs.lifecycle IN ('uploaded', 'parsing', 'unknown') OR coalesce(inb.n_inbox, 0) > bs.n_files THEN 'run-ingest' END,
  CASE WHEN bs.lifecycle = 'awaiting_annotation' THEN 'annotate' END,
  CASE WHEN bs.lifecycle IN ('annotated', 'predicted') THEN 'split-and-upload' END,
  CASE WHEN bs.lifecycle = 'delivering' THEN 'resume-delivery' END], lambda x: x IS NOT NULL), ',') AS actions
FROM bs LEFT JOIN inb ON inb.day_id = bs.day_id""")
def q_batch_actions(spark, sf_dir):
    from folio.plans.q_views import funnel_df
    bs = V.batch_status(funnel_df(spark, sf_dir), fx.fx_events(spark, sf_dir))
    inb = fx.fx_manifest(spark, sf_dir).where(F.col("volume") == "inbox").groupBy("day_id").agg(
        F.count(F.lit(1)).alias("n_inbox"))
    b = bs.join(inb, "day_id", "left").fillna(0, ["n_inbox"])
    return ST.batch_actions(b).select("day_id", "lifecycle", F.array_join("actions", ",").alias("actions"))


@query("run_row", f"""SELECT 'run-1' AS run_id, CAST(NULL AS VARCHAR) AS job_run_id, TIMESTAMP '{AS_OF_TEXT}' AS started_at,
  TIMESTAMP '{AS_OF_TEXT}' + INTERVAL 30 MINUTES AS completed_at,
  CASE WHEN count_if(status = 'error') > 0 AND count_if(status = 'parsed') > 0 THEN 'partial_failure'
       WHEN count_if(status = 'error') > 0 THEN 'failed' ELSE 'success' END AS status,
  count(*) AS n_total, CAST(count_if(status = 'parsed') + count_if(status = 'done') AS BIGINT) AS n_success,
  CAST(count_if(status = 'skipped') AS BIGINT) AS n_skipped, CAST(count_if(status = 'error') AS BIGINT) AS n_error,
  'primary' AS primary_model, 'fallback' AS fallback_model, CAST(30.0 AS DOUBLE) AS duration_min,
  concat('day_id=', day_id) AS notes
FROM fx_log GROUP BY day_id""")
def q_run_row(spark, sf_dir):
    from folio.sources.sinks import run_row
    out = IN.run_outcome(fx.fx_log(spark, sf_dir), "parse")
    start = as_of()
    return run_row(out, "run-1", start, start + F.expr("INTERVAL 30 MINUTES"), F.col("total"), "primary", "fallback")
