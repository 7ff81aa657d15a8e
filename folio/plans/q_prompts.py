"""Prompt-plan and response queries (PRM1-10, INT15, AGG11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions import prompt_text as P
from folio.functions.common import array_text
from folio.operators import prompts as PR
from folio.operators import signals as SG
from folio.plans import fixtures as fx
from folio.plans.q_signals import PACKAGE_SQL, SIGNALS_CTES, signals_df
from folio.plans.q_views import AS_OF_TEXT
from folio.plans.registry import query
from folio.sources import answers as AN


def sql_text(s: str) -> str:
    """A Python string as an oracle SQL literal (newlines as chr(10))."""
    parts = s.split("\n")
    return " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in parts)


def pkg_df(spark, sf_dir):
    return SG.package_summary(signals_df(spark, sf_dir))


@query("prompt_plan", f"""WITH {SIGNALS_CTES}, {PACKAGE_SQL}
SELECT filename, total_pages,
  CASE WHEN total_pages <= 30 THEN 'S' WHEN total_pages <= 60 THEN 'M' ELSE 'L' END AS token_bucket,
  CASE WHEN total_pages <= 30 THEN 500 WHEN total_pages <= 60 THEN 800 ELSE 2000 END AS max_tokens,
  md5({sql_text(P.BOUNDARY_SYSTEM + P.INPUT_OPEN)} || package_summary || {sql_text(P.BOUNDARY_TAIL)}) AS prompt_md5
FROM pkg WHERE total_pages <= 50""")
def q_prompt_plan(spark, sf_dir):
    plan = PR.prompt_plan(pkg_df(spark, sf_dir))
    return plan.select("filename", "total_pages", "token_bucket", "max_tokens",
                       F.md5(PR.primary_prompt(F.col("package_summary"))).alias("prompt_md5"))


def long_pkg(spark, sf_dir):
    """Packages for the chunk path: the long ones, and those of the single-call adapter above its page limit."""
    over = fx.fx_responses(spark, sf_dir).where(F.col("total_pages") > P.MAX_PAGES_SINGLE_CALL).select("filename", "total_pages")
    return fx.fx_long_packages(spark, sf_dir).unionByName(over)


CHUNK_PLAN_SQL = """lpkg AS (SELECT filename, max(total_pages) AS total_pages FROM fx_long_pages GROUP BY filename
  UNION ALL SELECT filename, total_pages FROM fx_responses WHERE total_pages > 50),
plan AS (SELECT filename, total_pages, CAST(s.i - 1 AS INT) AS chunk_idx, CAST(s.st AS INT) AS chunk_start,
    CAST(least(s.st + 49, total_pages) AS INT) AS chunk_end,
    CASE WHEN least(s.st + 49, total_pages) - s.st <= 30 THEN 'S' WHEN least(s.st + 49, total_pages) - s.st <= 60 THEN 'M'
         ELSE 'L' END AS token_bucket
  FROM lpkg p,
  LATERAL (SELECT unnest(generate_series(1, p.total_pages - 3, 47)) AS st,
                  unnest(generate_series(1, len(generate_series(1, p.total_pages - 3, 47)))) AS i) s
  WHERE p.total_pages > 50)"""


@query("chunk_plan", f"WITH {CHUNK_PLAN_SQL} SELECT * FROM plan")
def q_chunk_plan(spark, sf_dir):
    return PR.chunk_plan(long_pkg(spark, sf_dir)).select(
        "filename", "total_pages", "chunk_idx", "chunk_start", "chunk_end", "token_bucket")


@query("chunk_text", f"""WITH {CHUNK_PLAN_SQL},
ct AS (SELECT c.filename, c.chunk_idx, c.chunk_start, c.chunk_end, c.total_pages,
  string_agg(concat('=== PAGE ', CAST(p.page_num AS STRING), ' ===', chr(10), p.page_block,
             CASE WHEN p.page_num < p.total_pages THEN chr(10) ELSE '' END), chr(10) ORDER BY p.page_num) AS chunk_summary
  FROM plan c JOIN fx_long_pages p ON p.filename = c.filename AND p.page_num BETWEEN c.chunk_start AND c.chunk_end
  GROUP BY c.filename, c.chunk_idx, c.chunk_start, c.chunk_end, c.total_pages)
SELECT filename, chunk_idx, chunk_summary,
  md5({sql_text(P.BOUNDARY_SYSTEM + P.INPUT_OPEN + P.CHUNK_HEAD)} || CAST(chunk_start AS STRING) || '-' ||
      CAST(chunk_end AS STRING) || {sql_text(P.CHUNK_MID)} || CAST(total_pages AS STRING) || {sql_text(P.CHUNK_NOTE)}
      || chunk_summary || {sql_text(P.BOUNDARY_TAIL)}) AS prompt_md5
FROM ct""")
def q_chunk_text(spark, sf_dir):
    pages = fx.fx_long_pages(spark, sf_dir)
    plan = PR.chunk_plan(long_pkg(spark, sf_dir))
    text = PR.chunk_text(pages)
    j = plan.join(text, ["filename", "chunk_idx"])
    prompt = PR.chunk_prompt(F.col("chunk_start"), F.col("chunk_end"), F.col("total_pages"), F.col("chunk_summary"))
    return j.select("filename", "chunk_idx", "chunk_summary", F.md5(prompt).alias("prompt_md5"))


def parse_sql(src: str, raw: str = "raw_response", prefix: str = "p", out: str = "parsed") -> str:
    """CTEs {prefix}0..2 and ``out`` over ``src`` adding ``parsed_starts`` (oracle form of PRM7)."""
    return f"""{prefix}0 AS (SELECT *, regexp_extract(trim(regexp_replace({raw}, '```(?:json)?\\s*', '', 'g')),
    '(?s)\\{{.*?\\}}', 0) AS obj FROM {src}),
{prefix}1 AS (SELECT *, CASE WHEN obj <> '' AND json_valid(obj) THEN obj END AS js FROM {prefix}0),
{prefix}2 AS (SELECT *, json_type(js, '$.predicted_starts') AS pst,
    list_transform(CASE WHEN json_type(js, '$.predicted_starts') = 'ARRAY'
                        THEN json_extract(js, '$.predicted_starts[*]') END,
      lambda e: CASE WHEN json_type(e) IN ('BIGINT', 'UBIGINT', 'DOUBLE')
                       THEN CASE WHEN abs(CAST(e AS DOUBLE)) < 1.0e18 THEN CAST(trunc(CAST(e AS DOUBLE)) AS BIGINT) ELSE -1 END
                     WHEN json_type(e) = 'VARCHAR' AND regexp_matches(trim(json_extract_string(e, '$')), '^[+-]?[0-9]+$')
                       THEN coalesce(TRY_CAST(trim(json_extract_string(e, '$')) AS BIGINT), -1)
                     WHEN json_type(e) = 'BOOLEAN' THEN CASE WHEN CAST(e AS BOOLEAN) THEN 1 ELSE 0 END END) AS ints
  FROM {prefix}1),
{out} AS (SELECT * EXCLUDE (obj, js, pst, ints),
    CASE WHEN js IS NULL THEN NULL WHEN pst IS NULL THEN [1] WHEN pst <> 'ARRAY' THEN NULL
         WHEN list_contains(list_transform(ints, lambda x: x IS NULL), true) THEN NULL
         ELSE list_sort(list_distinct(list_concat([1], list_filter(ints, lambda x: x >= 1 AND x <= total_pages)))) END
      AS parsed_starts
  FROM {prefix}2)"""


def responses_df(spark, sf_dir):
    return PR.with_parsed(fx.fx_responses(spark, sf_dir))


@query("parse_starts", f"""WITH {parse_sql('fx_responses')}
SELECT filename, total_pages, raw_response, {'array_to_string(parsed_starts, \',\')'} AS starts_txt FROM parsed""")
def q_parse_starts(spark, sf_dir):
    r = responses_df(spark, sf_dir)
    return r.select("filename", "total_pages", "raw_response", array_text(F.col("parsed_starts")).alias("starts_txt"))


@query("split_outcomes", f"""WITH {parse_sql('fx_responses')}
SELECT filename, CASE WHEN error_message IS NULL AND parsed_starts IS NOT NULL THEN 'success' ELSE 'failure' END AS outcome
FROM parsed""")
def q_split_outcomes(spark, sf_dir):
    ok, bad = PR.split_outcomes(responses_df(spark, sf_dir))
    return (ok.select("filename", F.lit("success").alias("outcome"))
            .unionByName(bad.select("filename", F.lit("failure").alias("outcome"))))


@query("response_counts", f"""WITH {parse_sql('fx_responses')}
SELECT count(*) AS n_responses, CAST(count_if(error_message IS NOT NULL) AS BIGINT) AS n_errors,
  CAST(count_if(error_message IS NULL) AS BIGINT) AS n_success,
  CAST(count_if(error_message IS NULL AND parsed_starts IS NOT NULL) AS BIGINT) AS n_parsed FROM parsed""")
def q_response_counts(spark, sf_dir):
    return PR.response_counts(responses_df(spark, sf_dir))


@query("unpack_response", "SELECT filename, total_pages, raw_response, error_message FROM fx_responses")
def q_unpack_response(spark, sf_dir):
    r = fx.fx_responses(spark, sf_dir)
    packed = r.select("filename", "total_pages",
                      F.struct(F.col("raw_response").alias("result"),
                               F.col("error_message").alias("errorMessage")).alias("llm_result"))
    return PR.unpack_response(packed)


@query("log_responses", f"""WITH {parse_sql('fx_responses')}
SELECT filename, 'primary_pass' AS stage, 'primary' AS model_used,
  CASE WHEN total_pages <= 30 THEN 'S' WHEN total_pages <= 60 THEN 'M' ELSE 'L' END AS prompt_token_bucket,
  raw_response, error_message, array_to_string(parsed_starts, ',') AS starts_txt, false AS is_fallback,
  TIMESTAMP '{AS_OF_TEXT}' AS processing_timestamp, 'run-1' AS run_id, CAST(NULL AS VARCHAR) AS day_id
FROM parsed""")
def q_log_responses(spark, sf_dir):
    r = responses_df(spark, sf_dir).withColumn("token_bucket", PR.token_bucket(F.col("total_pages")))
    log = PR.log_responses(r, "primary_pass", "primary", False, "run-1", None,
                           F.lit(AS_OF_TEXT).cast("timestamp_ntz"))
    return log.withColumn("starts_txt", array_text(F.col("parsed_starts"))).drop("parsed_starts")


_QUESTION = """sha256(length('primary')::VARCHAR || chr(10) || length(max_tokens::VARCHAR)::VARCHAR || chr(10) || 'primary' || chr(10) ||
    max_tokens::VARCHAR || chr(10) || prompt)"""
#: Questions per order and a store of earlier runs: both response adapters, an order's text asked in groups of seven.
_ASKED_SQL = f"""asked AS (SELECT filename, CASE WHEN total_pages <= 30 THEN 500 WHEN total_pages <= 60 THEN 800 ELSE 2000 END AS max_tokens,
    'split ' || CAST(CAST(split_part(filename, '_', 1) AS BIGINT) // 7 AS VARCHAR) AS prompt FROM fx_responses),
keyed AS (SELECT *, {_QUESTION} AS question FROM asked),
runs AS (SELECT filename, raw_response, error_message, 1 AS tries FROM fx_responses
  UNION ALL SELECT filename, raw_response, error_message, 3 FROM fx_fallback_responses),
stored AS (SELECT question, raw_response AS result, error_message, tries FROM runs JOIN keyed USING (filename)
  WHERE CAST(split_part(filename, '_', 1) AS BIGINT) % 7 < 2 AND CAST(split_part(filename, '_', 1) AS BIGINT) % 3 > 0)"""


def _answer_tables(spark, sf_dir):
    order = F.split_part(F.col("filename"), F.lit("_"), F.lit(1)).cast("long")
    first, second = fx.fx_responses(spark, sf_dir), fx.fx_fallback_responses(spark, sf_dir)
    asked = first.select("filename", PR.max_tokens(PR.token_bucket(F.col("total_pages"))).alias("max_tokens"),
                         F.concat(F.lit("split "), F.floor(order / 7).cast("string")).alias("prompt"))
    asked = AN.with_question(asked, "primary")
    runs = first.withColumn("tries", F.lit(1)).unionByName(second.withColumn("tries", F.lit(3)))
    stored = (runs.where((order % 7 < 2) & (order % 3 > 0)).join(asked.select("filename", "question"), "filename")
              .select("question", F.col("raw_response").alias("result"), "error_message", "tries"))
    return asked, stored


@query("answers_missing", f"""WITH {_ASKED_SQL}
SELECT DISTINCT question, max_tokens, prompt FROM keyed
WHERE question NOT IN (SELECT question FROM stored WHERE error_message IS NULL)""")
def q_answers_missing(spark, sf_dir):
    asked, stored = _answer_tables(spark, sf_dir)
    return AN.unanswered(asked.select("question", "max_tokens", "prompt"), stored)


@query("answers_stored", f"""WITH {_ASKED_SQL},
best AS (SELECT question, coalesce(bool_or(error_message IS NULL), false) AS ok,
    list_sort(list(result) FILTER (error_message IS NULL), 'ASC', 'NULLS FIRST')[1] AS result, sum(tries) AS tries FROM stored GROUP BY question),
failed AS (SELECT question, (list({{'t': -tries, 'm': error_message}} ORDER BY tries DESC, error_message))[1].m AS error_message
  FROM stored WHERE error_message IS NOT NULL GROUP BY question)
SELECT filename, result AS raw_response, CASE WHEN NOT ok THEN error_message END AS error_message, CAST(tries AS INT) AS tries
FROM keyed LEFT JOIN best USING (question) LEFT JOIN failed USING (question)""")
def q_answers_stored(spark, sf_dir):
    asked, stored = _answer_tables(spark, sf_dir)
    told = PR.unpack_response(AN.answered(asked.select("filename", "question"), stored))
    tries = asked.select("filename", "question").join(AN.best_answers(stored).select("question", "tries"), "question", "left")
    return told.join(tries.select("filename", "tries"), "filename")


RULE_SQL = """flags AS (SELECT c.filename, c.page_num, c.total_pages,
    c.page_num = 1 OR regexp_matches(c.page_indicator, '^([Pp]age\\s+1\\s*(/|of)|-\\s*1\\s*/)')
    OR (NOT regexp_matches(c.page_indicator, '^[Pp]age\\s+0*([2-9]|[1-9]\\d+)\\s*(/|of)|^-\\s*0*([2-9]|[1-9]\\d+)\\s*/')
        AND ((c.invoice_number <> '' AND coalesce(p.invoice_number, '') <> '' AND c.invoice_number <> p.invoice_number)
          OR (c.doc_ref <> '' AND coalesce(p.doc_ref, '') <> '' AND c.doc_ref <> p.doc_ref)
          OR (c.form_number <> '' AND c.form_number <> coalesce(p.form_number, '')))) AS is_start
  FROM sig c LEFT JOIN sig p ON p.filename = c.filename AND p.page_num + 1 = c.page_num),
rules AS (SELECT filename, max(total_pages) AS total_pages,
  list_sort(list_distinct(list_concat([1], list(page_num) FILTER (WHERE is_start)))) AS predicted_starts
  FROM flags GROUP BY filename)"""


@query("rule_boundaries", f"""WITH {SIGNALS_CTES}, {RULE_SQL}
SELECT filename, total_pages, array_to_string(predicted_starts, ',') AS starts_txt FROM rules""")
def q_rule_boundaries(spark, sf_dir):
    s = PR.starts_per_package(PR.rule_boundaries(signals_df(spark, sf_dir)))
    return s.select("filename", "total_pages", array_text(F.col("predicted_starts")).alias("starts_txt"))
