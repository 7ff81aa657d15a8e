"""Evaluation queries (EVL1-10, AGG6-8) over the boundary-set adapters."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions import metrics as M
from folio.functions.common import array_text
from folio.operators import evaluation as EV
from folio.operators import views as V
from folio.plans import fixtures as fx
from folio.plans.q_views import BATCH_STATUS_CTES, FILE_STATUS_CTES
from folio.plans.registry import query
from folio.plans.sqlfrag import atext, metric_ctes, r4, units4
from folio.sources.sinks import cut_lineage

ORDER_DAY_SQL = """(SELECT concat(CAST(o_orderkey AS STRING),'_ORDER') AS filename,
  replace(substr(CAST(o_orderdate AS STRING),1,7),'-','') AS day_id FROM orders)"""


def order_days(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    return o.select(F.concat(F.col("o_orderkey").cast("string"), F.lit("_ORDER")).alias("filename"),
                    F.date_format("o_orderdate", "yyyyMM").alias("day_id"))


def eval_rows(spark, sf_dir):
    """Evaluation rows: ground truth of every package, left-joined with its prediction."""
    sets = cut_lineage(fx.fx_eval_sets(spark, sf_dir))  # the pages are ordered once, not for each side of the join
    gt = sets.select("filename", "total_pages", "gt_starts")
    pred = sets.where(F.col("model_starts").isNotNull()).select("filename", "model_starts")
    return EV.evaluate(gt, pred).join(order_days(spark, sf_dir), "filename", "left")


EVAL_CTES = f"""WITH RECURSIVE {metric_ctes('fx_eval_sets')},
ev AS (SELECT met.*, od.day_id, len(gfull) > 1 AS gt_is_multidoc FROM met LEFT JOIN {ORDER_DAY_SQL} od
       ON od.filename = met.filename)"""


@query("boundary_metrics", EVAL_CTES + """
SELECT filename, exact_match, n_true_positive, n_false_positive, n_false_negative, precision, recall, f1,
  model_is_multidoc, multidoc_correct FROM ev WHERE model_starts IS NOT NULL""")
def q_boundary_metrics(spark, sf_dir):
    return eval_rows(spark, sf_dir).where(F.col("model_starts").isNotNull()).select(
        "filename", "exact_match", "n_true_positive", "n_false_positive", "n_false_negative", "precision",
        "recall", "f1", "model_is_multidoc", "multidoc_correct")


@query("tolerant_metrics", EVAL_CTES + """
SELECT filename, tp_tol, n_offby1, precision_tol, recall_tol, f1_tol FROM ev WHERE model_starts IS NOT NULL""")
def q_tolerant_metrics(spark, sf_dir):
    return eval_rows(spark, sf_dir).where(F.col("model_starts").isNotNull()).select(
        "filename", "tp_tol", "n_offby1", "precision_tol", "recall_tol", "f1_tol")


@query("exact_match", f"""SELECT filename, {atext('gt_starts')} AS gt_txt, {atext('model_starts')} AS model_txt,
  list_sort(list_distinct(gt_starts)) = list_sort(list_distinct(model_starts)) AS exact_match
FROM fx_eval_sets WHERE model_starts IS NOT NULL""")
def q_exact_match(spark, sf_dir):
    s = fx.fx_eval_sets(spark, sf_dir).where(F.col("model_starts").isNotNull())
    return s.select("filename", array_text(F.col("gt_starts")).alias("gt_txt"),
                    array_text(F.col("model_starts")).alias("model_txt"),
                    (M.normalize(F.col("gt_starts")) == M.normalize(F.col("model_starts"))).alias("exact_match"))


EVAL_COLS = ["filename", "day_id", "total_pages", "gt_n_documents", "gt_is_multidoc", "model_n_documents",
             "exact_match", "n_true_positive", "n_false_positive", "n_false_negative", "precision", "recall",
             "f1", "n_offby1", "precision_tol", "recall_tol", "f1_tol", "multidoc_correct"]


@query("evaluate", EVAL_CTES + f"""
SELECT filename, day_id, total_pages, {atext('gt_starts')} AS gt_txt, {atext('model_starts')} AS model_txt,
  CAST(len(gt_starts) AS INTEGER) AS gt_n_documents, gt_is_multidoc, CAST(len(model_starts) AS INTEGER) AS model_n_documents,
  exact_match,
  n_true_positive, n_false_positive, n_false_negative, precision, recall, f1, n_offby1, precision_tol,
  recall_tol, f1_tol, multidoc_correct FROM ev""")
def q_evaluate(spark, sf_dir):
    return eval_rows(spark, sf_dir).select(
        *EVAL_COLS, array_text(F.col("gt_starts")).alias("gt_txt"),
        array_text(F.col("model_starts")).alias("model_txt"))


def _stats_sql(where: str = "") -> str:
    wm = "(model_starts IS NOT NULL AND exact_match IS NOT NULL)"

    def avg4(c):
        ok = f"{wm} AND {c} IS NOT NULL"
        return (f"{r4(f'coalesce(sum(CASE WHEN {ok} THEN {units4(c)} END), 0)', f'count_if({ok}) * 10000')}"
                f" AS avg_{c}")

    return f"""CAST(count(*) AS BIGINT) AS n_annotated, CAST(count_if({wm}) AS BIGINT) AS n_with_model,
  CAST(count(*) - count_if({wm}) AS BIGINT) AS n_no_model,
  CAST(count_if({wm} AND exact_match) AS BIGINT) AS n_exact,
  {r4(f'count_if({wm} AND exact_match)', f'count_if({wm})')} AS exact_rate,
  CAST(count_if({wm} AND multidoc_correct) AS BIGINT) AS n_multidoc_correct,
  {r4(f'count_if({wm} AND multidoc_correct)', f'count_if({wm})')} AS multidoc_rate,
  CAST(coalesce(sum(CASE WHEN {wm} THEN coalesce(n_offby1, 0) END), 0) AS BIGINT) AS n_offby1_total,
  {avg4('precision')}, {avg4('recall')}, {avg4('f1')}, {avg4('f1_tol')},
  CAST(count_if(gt_is_multidoc) AS BIGINT) AS n_gt_multidoc,
  CAST(count(*) - count_if(gt_is_multidoc) AS BIGINT) AS n_gt_single"""


@query("eval_stats", EVAL_CTES + f"\nSELECT {_stats_sql()} FROM ev")
def q_eval_stats(spark, sf_dir):
    return EV.eval_stats(eval_rows(spark, sf_dir))


@query("eval_stats_grouped", EVAL_CTES + f"""
SELECT CASE WHEN grouping(bucket) = 1 THEN 'all' ELSE bucket END AS bucket, {_stats_sql()}
FROM (SELECT *, CASE WHEN gt_is_multidoc THEN 'multidoc' ELSE 'single' END AS bucket FROM ev) b
GROUP BY GROUPING SETS ((), (bucket))""")
def q_eval_stats_grouped(spark, sf_dir):
    return EV.eval_stats_grouped(eval_rows(spark, sf_dir))


@query("gate_metrics", EVAL_CTES + f"""
SELECT day_id, count(*) AS n_evaluated,
  CAST(count_if(exact_match) AS DOUBLE) / count(*) AS exact_match_rate,
  CAST(count_if(multidoc_correct) AS DOUBLE) / count(*) AS multidoc_rate,
  CAST(sum({units4('precision')}) AS DOUBLE) / (count(precision) * 10000.0) AS avg_precision,
  CAST(sum({units4('recall')}) AS DOUBLE) / (count(recall) * 10000.0) AS avg_recall,
  CAST(sum({units4('f1')}) AS DOUBLE) / (count(f1) * 10000.0) AS avg_f1,
  CAST(sum({units4('f1_tol')}) AS DOUBLE) / (count(f1_tol) * 10000.0) AS avg_f1_tol
FROM ev WHERE model_starts IS NOT NULL GROUP BY day_id""")
def q_gate_metrics(spark, sf_dir):
    return EV.gate_metrics(eval_rows(spark, sf_dir))


def _volumes(spark, sf_dir):
    man = fx.fx_manifest(spark, sf_dir)
    sample = man.where(F.col("volume") == "validation")
    gt = man.where(F.col("volume") == "ground_truth")
    return man, sample, gt


WORKLIST_SQL = """wl AS (SELECT s.day_id, s.filename, g.filename IS NOT NULL AS annotated
  FROM (SELECT * FROM fx_manifest WHERE volume = 'validation') s
  LEFT JOIN (SELECT DISTINCT day_id, filename FROM fx_manifest WHERE volume = 'ground_truth') g
  ON g.day_id = s.day_id AND g.filename = s.filename),
gs AS (SELECT day_id, count(*) AS n_sampled, CAST(count_if(annotated) AS BIGINT) AS n_annotated,
  count(*) - count_if(annotated) AS n_missing, count(*) > 0 AND count(*) - count_if(annotated) = 0 AS complete
  FROM wl GROUP BY day_id)"""


@query("worklist", f"WITH {WORKLIST_SQL} SELECT * FROM wl")
def q_worklist(spark, sf_dir):
    _, sample, gt = _volumes(spark, sf_dir)
    return EV.worklist(sample, gt)


@query("gate_state", f"WITH {WORKLIST_SQL} SELECT * FROM gs")
def q_gate_state(spark, sf_dir):
    _, sample, gt = _volumes(spark, sf_dir)
    return EV.gate_state(sample, gt)


@query("delivery_allowed", f"""WITH {FILE_STATUS_CTES}, {WORKLIST_SQL}
SELECT d.day_id, coalesce(gs.n_sampled, 0) AS n_sampled, coalesce(gs.n_annotated, 0) AS n_annotated,
  coalesce(gs.n_sampled, 0) = 0 OR coalesce(gs.complete, false) AS allowed
FROM (SELECT DISTINCT day_id FROM fs) d LEFT JOIN gs ON gs.day_id = d.day_id""")
def q_delivery_allowed(spark, sf_dir):
    from folio.plans.q_views import status_df
    _, sample, gt = _volumes(spark, sf_dir)
    return EV.delivery_allowed(status_df(spark, sf_dir), EV.gate_state(sample, gt))


@query("batch_list", f"""WITH {BATCH_STATUS_CTES},
{WORKLIST_SQL},
inb AS (SELECT day_id, count(*) AS n_inbox FROM fx_manifest WHERE volume = 'inbox' GROUP BY day_id),
days AS (SELECT day_id FROM bs UNION SELECT day_id FROM inb
         UNION SELECT day_id FROM fx_manifest WHERE volume = 'validation')
SELECT days.day_id,
  CASE WHEN coalesce(bs.lifecycle, 'uploaded') = 'awaiting_annotation' AND coalesce(gs.complete, false)
       THEN 'annotated' ELSE coalesce(bs.lifecycle, 'uploaded') END AS lifecycle,
  coalesce(bs.has_errors, false) AS has_errors, coalesce(bs.n_files, 0) AS n_files,
  coalesce(inb.n_inbox, 0) AS n_inbox
FROM days LEFT JOIN bs ON bs.day_id = days.day_id LEFT JOIN inb ON inb.day_id = days.day_id
LEFT JOIN gs ON gs.day_id = days.day_id""")
def q_batch_list(spark, sf_dir):
    from folio.plans.q_views import funnel_df
    man, sample, gt = _volumes(spark, sf_dir)
    bs = V.batch_status(funnel_df(spark, sf_dir), fx.fx_events(spark, sf_dir))
    return EV.batch_list(bs, man, EV.gate_state(sample, gt))


@query("build_ground_truth", f"""WITH c AS (SELECT filename, total_pages,
    list_sort(list_distinct(list_concat([1], list_filter(list_concat(gt_starts, [0, total_pages + 1]),
      lambda x: x >= 1 AND x <= total_pages)))) AS s FROM fx_eval_sets)
SELECT filename, total_pages, len(s) > 1 AS is_multidoc, {atext('s')} AS starts_txt, CAST(len(s) AS INTEGER) AS n_documents,
  array_to_string(list_transform(generate_series(1, len(s)),
    lambda i: concat(CAST(s[i] AS STRING), '-', CAST(coalesce(s[i + 1] - 1, total_pages) AS STRING))), ';') AS docs_txt,
  1 AS schema_version
FROM c""")
def q_build_ground_truth(spark, sf_dir):
    s = fx.fx_eval_sets(spark, sf_dir).select(
        "filename", "total_pages",
        F.concat("gt_starts", F.array(F.lit(0), F.col("total_pages") + 1)).alias("gt_starts"))
    g = EV.build_ground_truth(s)
    docs = F.array_join(F.transform("documents", lambda d: F.concat(d["start"].cast("string"), F.lit("-"),
                                                                    d["end"].cast("string"))), ";")
    return g.select("filename", "total_pages", "is_multidoc", array_text(F.col("predicted_starts")).alias("starts_txt"),
                    "n_documents", docs.alias("docs_txt"), "schema_version")


@query("to_documents", """SELECT filename, CAST(i AS INTEGER) AS doc_index, gt_starts[i] AS start,
  coalesce(gt_starts[i + 1] - 1, total_pages) AS "end"
FROM (SELECT filename, total_pages, gt_starts, generate_subscripts(gt_starts, 1) AS i FROM fx_eval_sets) t""")
def q_to_documents(spark, sf_dir):
    s = fx.fx_eval_sets(spark, sf_dir)
    d = s.select("filename", F.posexplode(M.to_documents(F.col("gt_starts"), F.col("total_pages"))))
    return d.select("filename", (F.col("pos") + 1).cast("int").alias("doc_index"),
                    F.col("col.start").alias("start"), F.col("col.end").alias("end"))


@query("parse_int_array", """WITH t AS (SELECT filename, CASE WHEN total_pages % 2 = 0
    THEN concat('[', array_to_string(gt_starts, ', '), ']')
    ELSE concat('["', array_to_string(gt_starts, '","'), '"]') END AS raw FROM fx_eval_sets)
SELECT filename, raw, array_to_string(list_transform(
    list_filter(string_split(regexp_replace(trim(raw), '^\\[|\\]$', '', 'g'), ','), lambda x: trim(x) <> ''),
    lambda x: CAST(regexp_replace(trim(x), '^["'']|["'']$', '', 'g') AS INT)), ',') AS parsed_txt FROM t""")
def q_parse_int_array(spark, sf_dir):
    s = fx.fx_eval_sets(spark, sf_dir)
    raw = F.when(F.col("total_pages") % 2 == 0, F.concat(F.lit("["), F.array_join("gt_starts", ", "), F.lit("]"))) \
           .otherwise(F.concat(F.lit('["'), F.array_join("gt_starts", '","'), F.lit('"]')))
    t = s.select("filename", raw.alias("raw"))
    return t.select("filename", "raw", array_text(M.parse_int_array(F.col("raw"))).alias("parsed_txt"))
