"""The split stage over real text: pages cut from ``documents``, long and short packages, native answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions import prompt_text as P
from folio.functions.common import array_text
from folio.operators import boundaries as BD
from folio.operators import prompts as PR
from folio.operators import signals as SG
from folio.plans import fixtures as fx
from folio.plans.q_prompts import RULE_SQL, sql_text
from folio.plans.q_signals import PACKAGE_SQL, SIGNAL_COLS, signals_ctes
from folio.plans.registry import query
from folio.sources.sinks import cut_lineage

DOC_CTES = signals_ctes("fx_doc_elements")


def doc_signals(spark, sf_dir):
    return SG.page_signals(SG.parse_elements(fx.fx_doc_parsed(spark, sf_dir)))


@query("doc_page_signals", f"WITH {DOC_CTES} SELECT * FROM sig")
def q_doc_page_signals(spark, sf_dir):
    return doc_signals(spark, sf_dir).select(*SIGNAL_COLS)


@query("doc_package_summary", f"""WITH {DOC_CTES}, {PACKAGE_SQL}
SELECT filename, total_pages, length(package_summary) AS n_chars, md5(package_summary) AS summary_md5 FROM pkg""")
def q_doc_package_summary(spark, sf_dir):
    s = SG.package_summary(doc_signals(spark, sf_dir))
    return s.select("filename", "total_pages", F.length("package_summary").cast("bigint").alias("n_chars"),
                    F.md5("package_summary").alias("summary_md5"))


def answer_text(starts):
    return F.concat(F.lit('{"predicted_starts": ['), F.array_join(F.transform(starts, lambda x: x.cast("string")), ", "), F.lit("]}"))


def doc_resolved(spark, sf_dir):
    """Every package with its boundary set: the answers are a relation made by the rule predictor, one per
    single-call package and one per chunk of a long one (some of them unusable), parsed like a model's."""
    rules = cut_lineage(PR.starts_per_package(PR.rule_boundaries(doc_signals(spark, sf_dir))))
    key = F.split("filename", "_")[0].cast("bigint")
    broken = F.when(key % 11 == 3, F.lit("no answer"))
    whole = rules.where(F.col("total_pages") <= P.MAX_PAGES_SINGLE_CALL).select(
        "filename", "total_pages", PR.token_bucket(F.col("total_pages")).alias("token_bucket"),
        F.coalesce(broken, answer_text(F.col("predicted_starts"))).alias("raw_response"), F.lit(None).cast("string").alias("error_message"))
    second = whole.where(F.col("raw_response") == "no answer").select(
        "filename", "total_pages", F.when(key % 2 == 0, F.lit('{"predicted_starts": [1, 2]}')).alias("raw_response"),
        F.when(key % 2 == 1, F.lit("timeout")).alias("error_message"))
    single = BD.resolve_single(PR.with_parsed(whole), PR.with_parsed(second))
    chunks = PR.chunk_plan(rules).select(
        "filename", "total_pages", "chunk_idx", "chunk_start", "chunk_end", F.lit(None).cast("string").alias("error_message"),
        F.when(key % 5 != 0, answer_text(F.filter("predicted_starts", lambda x: x.between(F.col("chunk_start"), F.col("chunk_end") + 2))))
        .alias("raw_response"))
    merged = BD.merge_chunks(PR.with_parsed(chunks, out="chunk_starts"))
    large = rules.where(F.col("total_pages") > P.MAX_PAGES_SINGLE_CALL)
    return BD.combine(single, merged, BD.large_missing(large, merged))


RESOLVED_SQL = f"""{DOC_CTES}, {RULE_SQL},
keyed AS (SELECT *, CAST(split_part(filename, '_', 1) AS BIGINT) AS k FROM rules),
src AS (SELECT filename, total_pages,
    CASE WHEN total_pages > 50 THEN CASE WHEN k % 5 = 0 THEN [1] ELSE predicted_starts END
         WHEN k % 11 <> 3 THEN predicted_starts WHEN k % 2 = 0 THEN list_filter([1, 2], lambda x: x <= total_pages) ELSE [1] END AS parsed_starts,
    CASE WHEN total_pages > 50 THEN CASE WHEN k % 5 = 0 THEN 'ultimate_fallback' ELSE 'chunked' END
         WHEN k % 11 <> 3 THEN 'primary' WHEN k % 2 = 0 THEN 'fallback' ELSE 'ultimate_fallback' END AS boundary_source FROM keyed)"""


@query("doc_rule_boundaries", f"""WITH {DOC_CTES}, {RULE_SQL}
SELECT filename, total_pages, array_to_string(predicted_starts, ',') AS starts_txt FROM rules""")
def q_doc_rule_boundaries(spark, sf_dir):
    s = PR.starts_per_package(PR.rule_boundaries(doc_signals(spark, sf_dir)))
    return s.select("filename", "total_pages", array_text(F.col("predicted_starts")).alias("starts_txt"))


@query("doc_verify_batch", f"""WITH {RESOLVED_SQL},
bnd AS (SELECT filename, total_pages, unnest(list_filter(parsed_starts, lambda x: x > 1)) AS b FROM src),
win AS (SELECT b.filename, b.total_pages, b.b, printf(chr(10) || '=== PROPOSED BOUNDARY AT PAGE %d ===' || chr(10), b.b) || coalesce(string_agg(
    CASE WHEN o.off > -2 THEN chr(10) ELSE '' END || 'PAGE ' || p.page_num || ' (' || o.label || '):' || chr(10) || p.page_block,
    '' ORDER BY o.off), '') AS txt
  FROM bnd b CROSS JOIN (VALUES (-2, 'B-2'), (-1, 'B-1'), (0, 'B'), (1, 'B+1'), (2, 'B+2')) o(off, label)
  LEFT JOIN sig p ON p.filename = b.filename AND p.page_num = b.b + o.off GROUP BY b.filename, b.total_pages, b.b)
SELECT filename, total_pages, string_agg(b, ',' ORDER BY b) AS proposed_txt,
  md5({sql_text(P.VERIFY_SYSTEM + P.INPUT_OPEN + P.VERIFY_HEAD)} || CAST(list(b ORDER BY b) AS VARCHAR) ||
      {sql_text(P.VERIFY_MID)} || string_agg(txt, chr(10) ORDER BY b) || {sql_text(P.VERIFY_TAIL)}) AS prompt_md5
FROM win GROUP BY filename, total_pages""")
def q_doc_verify_batch(spark, sf_dir):
    windows = BD.verify_windows(BD.proposed(doc_resolved(spark, sf_dir)), doc_signals(spark, sf_dir))
    b = BD.with_verify_prompt(BD.verify_batch(windows))
    return b.select("filename", "total_pages", array_text(F.col("all_proposed")).alias("proposed_txt"), F.md5("prompt").alias("prompt_md5"))


@query("split_job", f"""WITH {RESOLVED_SQL}
SELECT filename, total_pages, array_to_string(CASE WHEN CAST(split_part(filename, '_', 1) AS BIGINT) % 3 = 0 AND len(parsed_starts) > 1
    THEN list_filter(parsed_starts, lambda x: x <> parsed_starts[2]) ELSE parsed_starts END, ',') AS starts_txt, boundary_source FROM src""")
def q_split_job(spark, sf_dir):
    """Parsed JSON -> signals -> answers -> resolution of single, fallback and chunked packages ->
    proposals -> corrections (every third package drops its first proposal) -> final boundaries."""
    resolved = cut_lineage(doc_resolved(spark, sf_dir))
    above = F.filter("parsed_starts", lambda x: x > 1)
    asked = resolved.where(F.size(above) > 0).select("filename", "total_pages", above.alias("all_proposed"))
    drop = F.concat(F.lit('[{"action": "remove", "from_page": '), F.element_at("all_proposed", 1).cast("string"), F.lit("}]"))
    third = F.split("filename", "_")[0].cast("bigint") % 3 == 0
    answers = asked.withColumn("verify_response", F.when(third, drop).otherwise(F.lit("[]"))).withColumn("verify_error", F.lit(None).cast("string"))
    final = BD.final_boundaries(BD.apply_corrections(answers), resolved)
    return (final.join(resolved.select("filename", "total_pages", "boundary_source"), "filename")
            .select("filename", "total_pages", array_text(F.col("predicted_starts")).alias("starts_txt"), "boundary_source"))
