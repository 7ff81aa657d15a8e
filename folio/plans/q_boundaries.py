"""Boundary-resolution queries (BND1-16) over responses and signals derived from the tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from folio.functions.common import array_text
from folio.operators import boundaries as BD
from folio.operators import prompts as PR
from folio.operators import signals as SG
from folio.plans import fixtures as fx
from folio.plans.q_prompts import CHUNK_PLAN_SQL, long_pkg, parse_sql, sql_text
from folio.plans.q_signals import PACKAGE_SQL, SIGNALS_CTES, signals_df
from folio.plans.q_views import AS_OF_TEXT
from folio.plans.registry import query
from folio.functions import prompt_text as P
from folio.session import ship
from folio.sources.sinks import cut_lineage

# ---- adapters for the model answers of the later stages ----------------------


def _key(filename):
    return F.split(filename, "_")[0].cast("bigint")


def chunk_responses(plan):
    """Per chunk: starts at the chunk start, ten pages in, and five pages past the
    chunk end (outside the chunk); some chunks time out, every chunk of one
    supplier in 17 does."""
    k = _key(F.col("filename"))
    err = (k % 17 == 0) | ((F.col("chunk_idx") + k) % 5 == 4)
    raw = F.when(~err, F.concat(F.lit('{"predicted_starts": ['), F.col("chunk_start").cast("string"), F.lit(", "),
                                (F.col("chunk_start") + 10).cast("string"), F.lit(", "),
                                (F.col("chunk_end") + 5).cast("string"), F.lit("]}")))
    r = plan.select("filename", "total_pages", "chunk_idx", "chunk_start", "chunk_end", raw.alias("raw_response"),
                    F.when(err, F.lit("timeout")).alias("error_message"))
    return PR.with_parsed(r, out="chunk_starts")


CHUNK_RESP_SQL = """cresp0 AS (SELECT *, CAST(split_part(filename, '_', 1) AS BIGINT) AS k FROM plan),
cresp1 AS (SELECT filename, total_pages, chunk_idx, chunk_start, chunk_end,
  CASE WHEN NOT (k % 17 = 0 OR (chunk_idx + k) % 5 = 4) THEN concat('{"predicted_starts": [', CAST(chunk_start AS STRING),
    ', ', CAST(chunk_start + 10 AS STRING), ', ', CAST(chunk_end + 5 AS STRING), ']}') END AS raw_response,
  CASE WHEN k % 17 = 0 OR (chunk_idx + k) % 5 = 4 THEN 'timeout' END AS error_message FROM cresp0)"""


def verify_responses(batch):
    """Per verified package, one of six answers: error, [], a fenced move, a remove,
    no JSON, or a mix of confirm / move-from-page-1 / mixed-case remove."""
    k = _key(F.col("filename")) % 6
    p2 = F.get(F.col("all_proposed"), 0).cast("string")
    p2n = (F.get(F.col("all_proposed"), 0) + 1).cast("string")
    last = F.element_at(F.col("all_proposed"), -1).cast("string")
    resp = (F.when(k == 0, F.lit(None).cast("string"))
            .when(k == 1, F.lit("[]"))
            .when(k == 2, F.concat(F.lit('```json\n[{"action": "move", "from_page": '), p2, F.lit(', "to_page": '),
                                   p2n, F.lit("}]\n```")))
            .when(k == 3, F.concat(F.lit('[{"action": "remove", "from_page": '), last, F.lit('.0}, 7, null, "x", {"action": "remove", "from_page": "2"}]')))
            .when(k == 4, F.lit("not json"))
            .otherwise(F.concat(F.lit('[{"action": "confirm", "from_page": '), p2,
                                F.lit('}, {"action": "move", "from_page": 1, "to_page": '),
                                F.col("total_pages").cast("string"), F.lit('}, {"action": "Remove", "from_page": 1}]'))))
    return batch.withColumn("verify_response", resp).withColumn(
        "verify_error", F.when(k == 0, F.lit("timeout")))


VERIFY_RESP_SQL = """vr AS (SELECT *,
  CASE CAST(split_part(filename, '_', 1) AS BIGINT) % 6 WHEN 0 THEN NULL WHEN 1 THEN '[]'
    WHEN 2 THEN concat('```json', chr(10), '[{"action": "move", "from_page": ', CAST(all_proposed[1] AS STRING),
                       ', "to_page": ', CAST(all_proposed[1] + 1 AS STRING), '}]', chr(10), '```')
    WHEN 3 THEN concat('[{"action": "remove", "from_page": ', CAST(all_proposed[len(all_proposed)] AS STRING),
                       '.0}, 7, null, "x", {"action": "remove", "from_page": "2"}]')
    WHEN 4 THEN 'not json'
    ELSE concat('[{"action": "confirm", "from_page": ', CAST(all_proposed[1] AS STRING),
                '}, {"action": "move", "from_page": 1, "to_page": ', CAST(total_pages AS STRING),
                '}, {"action": "Remove", "from_page": 1}]') END AS verify_response,
  CASE WHEN CAST(split_part(filename, '_', 1) AS BIGINT) % 6 = 0 THEN 'timeout' END AS verify_error
FROM vb)"""

# ---- single-call resolution ---------------------------------------------------


def primary_df(spark, sf_dir):
    r = fx.fx_responses(spark, sf_dir).where(F.col("total_pages") <= P.MAX_PAGES_SINGLE_CALL)
    return PR.with_parsed(r.withColumn("token_bucket", PR.token_bucket(F.col("total_pages"))))


def fallback_df(spark, sf_dir, primary):
    _, failures = PR.split_outcomes(primary)
    fb = fx.fx_fallback_responses(spark, sf_dir).join(failures.select("filename"), "filename", "left_semi")
    return PR.with_parsed(fb)


PRIMARY_SQL = f"""{parse_sql("(SELECT * FROM fx_responses WHERE total_pages <= 50)", prefix="sp", out="sparsed")},
prim AS (SELECT *, error_message IS NULL AND parsed_starts IS NOT NULL AS ok,
  CASE WHEN total_pages <= 30 THEN 'S' WHEN total_pages <= 60 THEN 'M' ELSE 'L' END AS token_bucket FROM sparsed),
{parse_sql("(SELECT * FROM fx_fallback_responses WHERE filename IN (SELECT filename FROM prim WHERE NOT ok))",
           prefix="fp", out="fparsed")},
res AS (SELECT p.filename, p.total_pages, p.token_bucket,
  CASE WHEN p.ok THEN p.parsed_starts WHEN f.error_message IS NULL AND f.parsed_starts IS NOT NULL THEN f.parsed_starts
       ELSE [1] END AS parsed_starts,
  CASE WHEN p.ok THEN 'primary' WHEN f.error_message IS NULL AND f.parsed_starts IS NOT NULL THEN 'fallback'
       ELSE 'ultimate_fallback' END AS boundary_source
  FROM prim p LEFT JOIN fparsed f ON f.filename = p.filename)"""


def resolved_single(spark, sf_dir):
    prim = cut_lineage(primary_df(spark, sf_dir))  # answers are parsed once, as in the job
    return BD.resolve_single(prim, fallback_df(spark, sf_dir, prim))


@query("fallback_prompts", f"""WITH {PRIMARY_SQL}
SELECT filename, total_pages, token_bucket FROM prim WHERE NOT ok""")
def q_fallback_prompts(spark, sf_dir):
    prim = primary_df(spark, sf_dir)
    _, failures = PR.split_outcomes(prim)
    return BD.fallback_prompts(prim.select("filename", "total_pages", "token_bucket"), failures)


@query("resolve_single", f"""WITH {PRIMARY_SQL}
SELECT filename, total_pages, token_bucket, array_to_string(parsed_starts, ',') AS starts_txt, boundary_source FROM res""")
def q_resolve_single(spark, sf_dir):
    r = resolved_single(spark, sf_dir)
    return r.select("filename", "total_pages", "token_bucket", array_text(F.col("parsed_starts")).alias("starts_txt"),
                    "boundary_source")


# ---- chunked resolution ---------------------------------------------------------


def merged_df(spark, sf_dir):
    return BD.merge_chunks(chunk_responses(PR.chunk_plan(long_pkg(spark, sf_dir))))


CHUNK_MERGE_SQL = f"""{CHUNK_PLAN_SQL}, {CHUNK_RESP_SQL},
{parse_sql("cresp1", prefix="cp", out="cparsed")},
merged AS (SELECT filename, total_pages,
  list_sort(list_distinct(list_concat([1], list(b)))) AS parsed_starts, 'L' AS token_bucket, 'chunked' AS boundary_source
  FROM (SELECT filename, total_pages, chunk_start, chunk_end, unnest(parsed_starts) AS b FROM cparsed) e
  WHERE b BETWEEN chunk_start AND chunk_end GROUP BY filename, total_pages),
missing AS (SELECT filename, total_pages, [1] AS parsed_starts, 'L' AS token_bucket, 'ultimate_fallback' AS boundary_source
  FROM lpkg WHERE total_pages > 50 AND filename NOT IN (SELECT filename FROM merged))"""


@query("merge_chunks", f"""WITH {CHUNK_MERGE_SQL}
SELECT filename, total_pages, array_to_string(parsed_starts, ',') AS starts_txt, boundary_source FROM merged""")
def q_merge_chunks(spark, sf_dir):
    m = merged_df(spark, sf_dir)
    return m.select("filename", "total_pages", array_text(F.col("parsed_starts")).alias("starts_txt"), "boundary_source")


@query("large_missing", f"""WITH {CHUNK_MERGE_SQL}
SELECT filename, total_pages, array_to_string(parsed_starts, ',') AS starts_txt, boundary_source FROM missing""")
def q_large_missing(spark, sf_dir):
    large = long_pkg(spark, sf_dir).where(F.col("total_pages") > P.MAX_PAGES_SINGLE_CALL)
    m = BD.large_missing(large, merged_df(spark, sf_dir))
    return m.select("filename", "total_pages", array_text(F.col("parsed_starts")).alias("starts_txt"), "boundary_source")


def combined_df(spark, sf_dir):
    large = long_pkg(spark, sf_dir).where(F.col("total_pages") > P.MAX_PAGES_SINGLE_CALL)
    merged = cut_lineage(merged_df(spark, sf_dir))
    return BD.combine(resolved_single(spark, sf_dir), merged, BD.large_missing(large, merged))


@query("combine", f"""WITH {PRIMARY_SQL},
{CHUNK_MERGE_SQL}
SELECT filename, total_pages, array_to_string(parsed_starts, ',') AS starts_txt, token_bucket, boundary_source FROM res
UNION ALL SELECT filename, total_pages, array_to_string(parsed_starts, ','), token_bucket, boundary_source FROM merged
UNION ALL SELECT filename, total_pages, array_to_string(parsed_starts, ','), token_bucket, boundary_source FROM missing""")
def q_combine(spark, sf_dir):
    c = combined_df(spark, sf_dir)
    return c.select("filename", "total_pages", array_text(F.col("parsed_starts")).alias("starts_txt"),
                    "token_bucket", "boundary_source")


@query("review_events", f"""WITH {PRIMARY_SQL},
{CHUNK_MERGE_SQL},
allr AS (SELECT filename, total_pages, boundary_source FROM res UNION ALL SELECT filename, total_pages, boundary_source
  FROM merged UNION ALL SELECT filename, total_pages, boundary_source FROM missing)
SELECT filename, 'split' AS stage, 'needs_review' AS event_type,
  CASE WHEN total_pages > 50 THEN {sql_text(BD.DETAIL_CHUNKS_LOST)} ELSE {sql_text(BD.DETAIL_BOTH_FAILED)} END AS detail
FROM allr WHERE boundary_source = 'ultimate_fallback'""")
def q_review_events(spark, sf_dir):
    return BD.review_events(combined_df(spark, sf_dir))


# ---- verification ---------------------------------------------------------------


def proposals_src(spark, sf_dir):
    """Proposed sets for the verification pass: the model sets of the evaluation adapter
    (their pages have signals, so the windows have text)."""
    s = fx.fx_eval_sets(spark, sf_dir, fx.fx_pages(spark, sf_dir, dealt=True)).where(F.col("model_starts").isNotNull())
    return s.select("filename", "total_pages", F.col("model_starts").alias("parsed_starts"))


PROPOSED_SQL = """src AS (SELECT filename, total_pages, model_starts AS parsed_starts FROM fx_eval_sets
  WHERE model_starts IS NOT NULL),
bnd AS (SELECT filename, total_pages, unnest(list_filter(parsed_starts, lambda x: x > 1)) AS proposed_boundary FROM src)"""


@query("proposed", f"WITH {PROPOSED_SQL} SELECT * FROM bnd")
def q_proposed(spark, sf_dir):
    return BD.proposed(proposals_src(spark, sf_dir))


WINDOW_SQL = f"""{PROPOSED_SQL},
win AS (SELECT b.filename, b.proposed_boundary, b.total_pages,
  printf(chr(10) || '=== PROPOSED BOUNDARY AT PAGE %d ===' || chr(10), b.proposed_boundary) || coalesce(string_agg(
    CASE WHEN o.off > -2 THEN chr(10) ELSE '' END || 'PAGE ' || p.page_num || ' (' || o.label || '):' || chr(10) || p.page_block,
    '' ORDER BY o.off), '') AS window_context
  FROM bnd b CROSS JOIN (VALUES (-2, 'B-2'), (-1, 'B-1'), (0, 'B'), (1, 'B+1'), (2, 'B+2')) o(off, label)
  LEFT JOIN sig p ON p.filename = b.filename AND p.page_num = b.proposed_boundary + o.off
  GROUP BY b.filename, b.proposed_boundary, b.total_pages),
vb AS (SELECT filename, total_pages, list_sort(list_distinct(list(proposed_boundary))) AS all_proposed,
  string_agg(window_context, chr(10) ORDER BY proposed_boundary) AS all_windows_context
  FROM win GROUP BY filename, total_pages)"""


def windows_df(spark, sf_dir):
    return BD.verify_windows(BD.proposed(proposals_src(spark, sf_dir)), signals_df(spark, sf_dir))


@query("verify_windows", f"WITH {SIGNALS_CTES}, {WINDOW_SQL} SELECT * FROM win")
def q_verify_windows(spark, sf_dir):
    return windows_df(spark, sf_dir)


def batch_df(spark, sf_dir):
    return BD.verify_batch(windows_df(spark, sf_dir))


@query("verify_batch", f"""WITH {SIGNALS_CTES}, {WINDOW_SQL}
SELECT filename, total_pages, array_to_string(all_proposed, ',') AS proposed_txt, all_windows_context,
  md5({sql_text(P.VERIFY_SYSTEM + P.INPUT_OPEN + P.VERIFY_HEAD)} || CAST(all_proposed AS VARCHAR) ||
      {sql_text(P.VERIFY_MID)} || all_windows_context || {sql_text(P.VERIFY_TAIL)}) AS prompt_md5
FROM vb""")
def q_verify_batch(spark, sf_dir):
    b = BD.with_verify_prompt(batch_df(spark, sf_dir))
    return b.select("filename", "total_pages", array_text(F.col("all_proposed")).alias("proposed_txt"),
                    "all_windows_context", F.md5("prompt").alias("prompt_md5"))


def prompt_digest(pieces, budget):
    """A stand-in model for streamed prompts: the MD5 of what it is told, piece by piece."""
    told = hashlib.md5()
    for piece in pieces:
        told.update(piece.encode())
    return told.hexdigest()


@query("streamed_prompts", f"""WITH {SIGNALS_CTES}, {WINDOW_SQL}, {PACKAGE_SQL}
SELECT 'package' AS kind, filename, md5({sql_text(P.BOUNDARY_SYSTEM + P.INPUT_OPEN)} || package_summary || {sql_text(P.BOUNDARY_TAIL)})
  AS prompt_md5 FROM pkg
UNION ALL SELECT 'verify', filename, md5({sql_text(P.VERIFY_SYSTEM + P.INPUT_OPEN + P.VERIFY_HEAD)} || CAST(all_proposed AS VARCHAR) ||
      {sql_text(P.VERIFY_MID)} || all_windows_context || {sql_text(P.VERIFY_TAIL)}) FROM vb""")
def q_streamed_prompts(spark, sf_dir):
    ship(spark)
    told = {"package": PR.invoke_stream(SG.page_blocks(signals_df(spark, sf_dir)), prompt_digest, ["filename"],
                                        head=P.BOUNDARY_SYSTEM + P.INPUT_OPEN, tail=P.BOUNDARY_TAIL),
            "verify": PR.invoke_stream(BD.verify_blocks(windows_df(spark, sf_dir)), prompt_digest, ["filename"],
                                       head=P.VERIFY_SYSTEM + P.INPUT_OPEN + P.VERIFY_HEAD, tail=P.VERIFY_TAIL)}
    one, two = (t.select(F.lit(k).alias("kind"), "filename", F.col("llm_result.result").alias("prompt_md5")) for k, t in told.items())
    return one.unionByName(two)


CORRECT_SQL = f"""{VERIFY_RESP_SQL},
vr2 AS (SELECT *, regexp_extract(trim(regexp_replace(verify_response, '```(?:json)?\\s*', '', 'g')), '(?s)\\[.*\\]', 0) AS arr_txt
  FROM vr),
vr3 AS (SELECT *, CASE WHEN verify_response IS NOT NULL AND verify_response <> '' AND arr_txt <> '' AND json_valid(arr_txt)
    THEN list_transform(json_extract(arr_txt, '$[*]'), lambda e: {{'action': json_extract_string(e, '$.action'),
      'from_page': CASE WHEN json_type(e, '$.from_page') IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN CAST(json_extract_string(e, '$.from_page') AS DOUBLE) END,
      'to_page': CASE WHEN json_type(e, '$.to_page') IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN CAST(json_extract_string(e, '$.to_page') AS DOUBLE) END}}) END AS items FROM vr2),
corr0 AS (SELECT filename, total_pages, verify_error, list_sort(list_reduce(coalesce(items, []),
  lambda acc, c: CASE
    WHEN lower(c.action) = 'move' THEN
      CASE WHEN c.to_page IS NOT NULL AND c.to_page BETWEEN 1 AND total_pages
           THEN list_distinct(list_append(CASE WHEN c.from_page IS NOT NULL AND c.from_page NOT IN (0, 1)
                                               THEN list_filter(acc, lambda x: x <> c.from_page) ELSE acc END, c.to_page))
           ELSE CASE WHEN c.from_page IS NOT NULL AND c.from_page NOT IN (0, 1)
                     THEN list_filter(acc, lambda x: x <> c.from_page) ELSE acc END END
    WHEN lower(c.action) = 'remove' AND c.from_page IS NOT NULL AND c.from_page NOT IN (0, 1)
      THEN list_filter(acc, lambda x: x <> c.from_page)
    ELSE acc END,
  CAST(list_sort(list_distinct(list_concat([1], all_proposed))) AS DOUBLE[]))) AS corrected_raw
FROM vr3),
corr AS (SELECT filename, total_pages, verify_error, CAST(corrected_raw AS INTEGER[]) AS corrected_starts FROM corr0)"""


def corrected_df(spark, sf_dir):
    return BD.apply_corrections(verify_responses(batch_df(spark, sf_dir)))


@query("apply_corrections", f"""WITH {SIGNALS_CTES}, {WINDOW_SQL}, {CORRECT_SQL}
SELECT filename, total_pages, array_to_string(corrected_starts, ',') AS corrected_txt, verify_error FROM corr""")
def q_apply_corrections(spark, sf_dir):
    c = corrected_df(spark, sf_dir)
    return c.select("filename", "total_pages", array_text(F.col("corrected_starts")).alias("corrected_txt"),
                    "verify_error")


FINAL_SQL = """fin AS (SELECT s.filename, CASE WHEN c.corrected_starts IS NOT NULL AND c.verify_error IS NULL
    THEN c.corrected_starts ELSE s.parsed_starts END AS predicted_starts
  FROM src s LEFT JOIN corr c ON c.filename = s.filename)"""


def final_df(spark, sf_dir):
    return BD.final_boundaries(corrected_df(spark, sf_dir), proposals_src(spark, sf_dir))


@query("final_boundaries", f"""WITH {SIGNALS_CTES}, {WINDOW_SQL}, {CORRECT_SQL}, {FINAL_SQL}
SELECT filename, array_to_string(predicted_starts, ',') AS starts_txt FROM fin""")
def q_final_boundaries(spark, sf_dir):
    f = final_df(spark, sf_dir)
    return f.select("filename", array_text(F.col("predicted_starts")).alias("starts_txt"))


@query("boundary_stats", f"""WITH {SIGNALS_CTES}, {WINDOW_SQL}, {CORRECT_SQL}, {FINAL_SQL}
SELECT count(*) AS n, avg(len(predicted_starts)) AS avg_docs, CAST(max(len(predicted_starts)) AS INTEGER) AS max_docs
FROM fin""")
def q_boundary_stats(spark, sf_dir):
    return BD.boundary_stats(final_df(spark, sf_dir))


# ---- provenance and split_results ---------------------------------------------------


def response_log(spark, sf_dir):
    at = F.lit(AS_OF_TEXT).cast("timestamp_ntz")
    prim = primary_df(spark, sf_dir)
    fb = fallback_df(spark, sf_dir, prim)
    chunks = chunk_responses(PR.chunk_plan(long_pkg(spark, sf_dir))).withColumnRenamed("chunk_starts", "parsed_starts")
    return (PR.log_responses(prim, "primary_pass", "primary", False, "run-1", None, at)
            .unionByName(PR.log_responses(chunks, "chunk_pass", "chunk", False, "run-1", None, at))
            .unionByName(PR.log_responses(fb.withColumn("token_bucket", PR.token_bucket(F.col("total_pages"))),
                                          "retry_fallback", "fallback", True, "run-1", None, at)))


LOG_SQL = f"""{PRIMARY_SQL},
{CHUNK_MERGE_SQL},
whence AS (SELECT filename, boundary_source FROM res UNION ALL SELECT filename, boundary_source FROM merged
  UNION ALL SELECT filename, boundary_source FROM missing),
rlog AS (SELECT filename, 'primary' AS model_used, false AS is_fallback FROM prim
  UNION ALL SELECT filename, 'fallback', true FROM fparsed UNION ALL SELECT filename, 'chunk', false FROM plan),
minfo AS (SELECT filename, bool_or(is_fallback) AS fallback_used, max(model_used) FILTER (is_fallback) AS fallback_model,
  max(model_used) FILTER (NOT is_fallback) AS primary_model FROM rlog GROUP BY filename)"""


@query("model_info", f"WITH {LOG_SQL} SELECT * FROM minfo")
def q_model_info(spark, sf_dir):
    return BD.model_info(response_log(spark, sf_dir))


@query("split_results", f"""WITH {SIGNALS_CTES}, {PACKAGE_SQL}, {WINDOW_SQL}, {CORRECT_SQL}, {FINAL_SQL},
{LOG_SQL}
SELECT fin.filename, pkg.total_pages, array_to_string(fin.predicted_starts, ',') AS starts_txt,
  CAST(len(fin.predicted_starts) AS INTEGER) AS n_documents,
  CASE WHEN m.fallback_used THEN m.fallback_model ELSE m.primary_model END AS model_used, m.fallback_used,
  true AS verification_applied, TIMESTAMP '{AS_OF_TEXT}' AS processing_timestamp, 'run-1' AS run_id,
  r.boundary_source = 'ultimate_fallback' AS needs_review, r.boundary_source
FROM fin JOIN pkg ON pkg.filename = fin.filename LEFT JOIN minfo m ON m.filename = fin.filename
LEFT JOIN whence r ON r.filename = fin.filename""")
def q_split_results(spark, sf_dir):
    pages = signals_df(spark, sf_dir).select("filename", "total_pages")
    sr = BD.split_results(proposals_src(spark, sf_dir), corrected_df(spark, sf_dir), response_log(spark, sf_dir).drop("day_id"),
                          pages, "run-1", None, F.lit(AS_OF_TEXT).cast("timestamp_ntz"), source=combined_df(spark, sf_dir))
    return sr.select("filename", "total_pages", array_text(F.col("predicted_starts")).alias("starts_txt"),
                     "n_documents", "model_used", "fallback_used", "verification_applied", "processing_timestamp",
                     "run_id", "needs_review", "boundary_source")
