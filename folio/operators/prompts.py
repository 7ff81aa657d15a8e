"""Prompt planning, chunking, response handling and predictors (PRM1-10, AGG11, INT15)."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions import prompt_text as P
from folio.functions.common import pkg_keys
from folio.functions.responses import with_parsed_starts
from folio.operators.signals import ordered_text
from folio.schemas import LLM_RESPONSES, conform

STRIDE = P.MAX_PAGES_SINGLE_CALL - P.CHUNK_OVERLAP


def token_bucket(pages: Column) -> Column:
    return (F.when(pages <= P.BUCKET_S_MAX_PAGES, "S").when(pages <= P.BUCKET_M_MAX_PAGES, "M").otherwise("L"))


def max_tokens(bucket: Column) -> Column:
    return F.when(bucket == "S", P.TOKENS_S).when(bucket == "M", P.TOKENS_M).otherwise(P.TOKENS_L)


def prompt_plan(pkg: DataFrame) -> DataFrame:
    """PRM1: single-call packages (<= 50 pages) with their token bucket and budget,
    in one pass (the budget is a column, not one filtered scan per bucket)."""
    b = token_bucket(F.col("total_pages"))
    return (pkg.where(F.col("total_pages") <= P.MAX_PAGES_SINGLE_CALL)
            .withColumn("token_bucket", b).withColumn("max_tokens", max_tokens(b)))


def chunk_plan(pkg: DataFrame) -> DataFrame:
    """PRM2/PRM4: windows of 50 pages overlapping by 3 for packages above 50 pages.

    Starts are 1, 48, 95, ... up to ``total_pages - 3``; each chunk ends at
    ``min(start + 49, total_pages)``.  Generated per row; no driver loop.
    """
    big = pkg.where(F.col("total_pages") > P.MAX_PAGES_SINGLE_CALL)
    starts = F.sequence(F.lit(1), F.col("total_pages") - P.CHUNK_OVERLAP, F.lit(STRIDE))
    c = big.select("*", F.posexplode(starts).alias("chunk_idx", "chunk_start"))
    c = c.withColumn("chunk_idx", F.col("chunk_idx").cast("int")).withColumn(
        "chunk_end", F.least(F.col("chunk_start") + P.MAX_PAGES_SINGLE_CALL - 1, F.col("total_pages")))
    return c.withColumn("token_bucket", token_bucket(F.col("chunk_end") - F.col("chunk_start")))


def page_chunks(pages: DataFrame) -> DataFrame:
    """Chunk index(es) of every page of a chunked package.

    A page p lies in chunk k iff 47k + 1 <= p <= 47k + 50, so only k = (p-1) div 47
    and the one before can hold it: two candidates per page, an equi-key for
    the join to the plan instead of a range join over all chunks of a package.
    """
    p = F.col("page_num")
    k = F.floor((p - 1) / STRIDE).cast("int")
    last = F.ceil((F.col("total_pages") - P.MAX_PAGES_SINGLE_CALL) / STRIDE).cast("int")
    cand = pages.where(F.col("total_pages") > P.MAX_PAGES_SINGLE_CALL).select(
        "*", F.explode(F.array(k - 1, k)).alias("chunk_idx"))
    start = F.col("chunk_idx") * STRIDE + 1
    return cand.where((F.col("chunk_idx") >= 0) & (F.col("chunk_idx") <= last) & (p >= start)
                      & (p <= start + P.MAX_PAGES_SINGLE_CALL - 1))


def chunk_text(pages: DataFrame) -> DataFrame:
    """PRM3: per chunk the labelled page blocks of its pages, in page order.

    Same text as cutting the package summary at its page headers: every block
    but the package's last page keeps the newline that separated it from the
    next page, and blocks are joined with a newline.  Missing pages are skipped.
    """
    pc = page_chunks(pages)
    tail = F.when(F.col("page_num") < F.col("total_pages"), F.lit("\n")).otherwise(F.lit(""))
    blk = F.concat(F.lit("=== PAGE "), F.col("page_num").cast("string"), F.lit(" ===\n"), F.col("page_block"), tail)
    return ordered_text(pc.withColumn("_blk", blk), [*pkg_keys(pc), "chunk_idx"], "page_num", "_blk", "chunk_summary")


def primary_prompt(summary: Column) -> Column:
    return F.concat(F.lit(P.BOUNDARY_SYSTEM), F.lit(P.INPUT_OPEN), summary, F.lit(P.BOUNDARY_TAIL))


def chunk_prompt(start: Column, end: Column, total: Column, text: Column) -> Column:
    return F.concat(F.lit(P.BOUNDARY_SYSTEM), F.lit(P.INPUT_OPEN), F.lit(P.CHUNK_HEAD), start.cast("string"),
                    F.lit("-"), end.cast("string"), F.lit(P.CHUNK_MID), total.cast("string"), F.lit(P.CHUNK_NOTE),
                    text, F.lit(P.BOUNDARY_TAIL))


def verify_prompt(proposed: Column, windows: Column) -> Column:
    return F.concat(F.lit(P.VERIFY_SYSTEM), F.lit(P.INPUT_OPEN), F.lit(P.VERIFY_HEAD), proposed.cast("string"),
                    F.lit(P.VERIFY_MID), windows, F.lit(P.VERIFY_TAIL))


def unpack_response(df: DataFrame, col: str = "llm_result") -> DataFrame:
    """PRM6: response struct -> raw_response, error_message."""
    return (df.withColumn("raw_response", F.col(f"{col}.result"))
            .withColumn("error_message", F.col(f"{col}.errorMessage")).drop(col))


def with_parsed(df: DataFrame, raw: str = "raw_response", out: str = "parsed_starts") -> DataFrame:
    """PRM7 over a response relation (needs ``total_pages``)."""
    return with_parsed_starts(df, raw, "total_pages", out)


def is_success() -> Column:
    return F.col("error_message").isNull() & F.col("parsed_starts").isNotNull()


def split_outcomes(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """INT15: (successes, failures); failure = model error or unparseable response."""
    ok = is_success()
    return parsed.where(ok), parsed.where(~ok)


def response_counts(parsed: DataFrame) -> DataFrame:
    """AGG11: one pass for error / success / parsed counts."""
    err = F.col("error_message").isNotNull()
    return parsed.agg(F.count(F.lit(1)).alias("n_responses"),
                      F.sum(F.when(err, 1).otherwise(0)).cast("bigint").alias("n_errors"),
                      F.sum(F.when(~err, 1).otherwise(0)).cast("bigint").alias("n_success"),
                      F.sum(F.when(is_success(), 1).otherwise(0)).cast("bigint").alias("n_parsed"))


def log_responses(df: DataFrame, stage: str, model: str, is_fallback: bool, run_id: str | None,
                  day_id: str | None, at: Column | None = None) -> DataFrame:
    """PRM8: response audit rows in the gcs_llm_responses layout."""
    b = F.col("token_bucket") if "token_bucket" in df.columns else F.lit("L")
    out = df.select(
        "filename", F.lit(stage).alias("stage"), F.lit(model).alias("model_used"), b.alias("prompt_token_bucket"),
        "raw_response", "error_message",
        (F.col("parsed_starts") if "parsed_starts" in df.columns else F.lit(None).cast("array<int>")).alias("parsed_starts"),
        F.lit(is_fallback).alias("is_fallback"),
        (at if at is not None else F.current_timestamp()).alias("processing_timestamp"),
        F.lit(run_id).cast("string").alias("run_id"),
        (F.col("day_id") if "day_id" in df.columns else F.lit(day_id).cast("string")).alias("day_id"))
    return conform(out, LLM_RESPONSES)


RESULT_TYPE = T.StructType([T.StructField("result", T.StringType()), T.StructField("errorMessage", T.StringType())])


def invoke(prompts: DataFrame, predictor: Callable[[str, int], str], keys: list[str],
           prompt_col: str = "prompt", budget_col: str = "max_tokens", partitions: int | None = None,
           concurrency: int = 1, tries: int = 1, delay: float = 0.0, with_tries: bool = False) -> DataFrame:
    """PRM9: call ``predictor(prompt, max_tokens)`` on every row, failures as data.

    Runs in Arrow batches through ``mapInPandas``; each row's exception becomes
    its ``errorMessage`` so one bad call never fails the task (``failOnError``
    off).  ``partitions`` spreads the prompts evenly (round robin) over that many
    tasks, so calls are not stuck behind a skewed upstream partition;
    ``concurrency`` > 1 overlaps the latency-bound calls of one task with a
    bounded thread pool.  A call that fails is tried up to ``tries`` times, ``delay`` seconds
    after the first failure and twice as long after each further one; ``with_tries`` adds the number of calls made.
    Cut the result's lineage (``sinks.cut_lineage``) before using it twice, so a model is never called again
    on recomputation, or ask through ``sources.answers``, so that no later run calls it again either.
    """
    schema = T.StructType([f for f in prompts.select(*keys).schema.fields] + [T.StructField("llm_result", RESULT_TYPE)])
    if with_tries:
        schema = schema.add("tries", T.IntegerType())
    cols = list(dict.fromkeys([*keys, prompt_col, *([budget_col] if budget_col in prompts.columns else [])]))

    def call(prompt, budget):
        for n in range(1, max(tries, 1) + 1):
            try:
                return {"result": predictor(prompt, budget), "errorMessage": None}, n
            except Exception as ex:  # noqa: BLE001 - failures are data here
                failure = f"{type(ex).__name__}: {ex}"
            if n < tries and delay:
                time.sleep(delay * 2 ** (n - 1))
        return {"result": None, "errorMessage": failure}, n

    def run(batches: Iterator) -> Iterator:
        import pandas as pd
        pool = None
        if concurrency > 1:
            from concurrent.futures import ThreadPoolExecutor
            pool = ThreadPoolExecutor(max_workers=concurrency)
        try:
            for pdf in batches:
                budgets = pdf[budget_col] if budget_col in pdf.columns else [None] * len(pdf)
                pairs = list(zip(pdf[prompt_col], budgets))
                results = list(pool.map(lambda a: call(*a), pairs)) if pool else [call(p, b) for p, b in pairs]
                out = pdf[keys].copy()
                out["llm_result"] = pd.Series([r for r, _ in results], index=pdf.index, dtype=object)
                if with_tries:
                    out["tries"] = pd.Series([n for _, n in results], index=pdf.index, dtype="int32")
                yield out
        finally:
            if pool:
                pool.shutdown()

    src = prompts.select(*cols)
    if partitions:
        src = src.repartition(partitions)
    return src.mapInPandas(run, schema)


def invoke_stream(blocks: DataFrame, predictor: Callable[[Iterator[str], int | None], str], keys: list[str], head: str = "",
                  tail: str = "", budget: int | None = None, sep: str = "\n") -> DataFrame:
    """PRM9 for prompts of any length: ``predictor(pieces, budget)`` reads a package's prompt as an iterator of texts.

    ``blocks`` has rows (keys, position, text); see ``signals.page_blocks`` and ``boundaries.verify_blocks``.  They are dealt by
    ``keys`` and sorted by position within the task, and a task holds one Arrow batch of them at a time, however long
    a package is: a package that goes over a batch's end is read on from the next batch.  The pieces are ``head``, the
    texts of negative positions as they are, the others with ``sep`` between them, and ``tail``.  Null texts are left out.
    A predictor need not read to the end.  A failure is data; a stream is not read again, so there is one try.
    """
    schema = T.StructType([*blocks.select(*keys).schema.fields, T.StructField("llm_result", RESULT_TYPE)])
    held_rows, held_chars = 1_000, 4_000_000

    def run(batches: Iterator) -> Iterator:
        import itertools

        import pandas as pd

        def rows():
            for pdf in batches:
                named = [pdf[k].astype(object).where(pdf[k].notna(), None) for k in keys]
                yield from zip(zip(*named), pdf["position"], pdf["text"])

        def pieces(group):
            yield head
            first = True
            for _, position, text in group:
                if text is None:
                    continue
                if position < 0:
                    yield text
                else:
                    yield text if first else sep + text
                    first = False
            yield tail

        def frame(done):
            out = pd.DataFrame([key for key, _ in done], columns=keys)
            out["llm_result"] = pd.Series([told for _, told in done], dtype=object)
            return out

        done, chars = [], 0
        for key, group in itertools.groupby(rows(), key=lambda r: r[0]):
            try:
                told = {"result": predictor(pieces(group), budget), "errorMessage": None}
            except Exception as ex:  # noqa: BLE001 - failures are data here
                told = {"result": None, "errorMessage": f"{type(ex).__name__}: {ex}"}
            done.append((key, told))
            chars += len(told["result"] or "")
            if len(done) >= held_rows or chars >= held_chars:
                yield frame(done)
                done, chars = [], 0
        if done:
            yield frame(done)

    # numbered within the package: rows that are dealt and sorted by package already are neither shuffled nor sorted again
    at = F.row_number().over(Window.partitionBy(*keys).orderBy("position")).alias("at")
    return blocks.select(*keys, "position", "text", at).mapInPandas(run, schema)


def rule_boundaries(signals: DataFrame) -> DataFrame:
    """PRM10: the prompt's boundary cues as a deterministic predictor.

    A page starts a document when it is page 1, when its page indicator reads
    page 1 of N, or -- unless its indicator says it continues (page N > 1) --
    when the invoice number or the doc reference changes from the previous
    page, or a form number appears or changes.  Each page is sent to its own number and to
    the next one, and one aggregation brings a page and the one before together: the
    signals are computed once and a huge package is spread over many tasks.
    """
    cues = F.struct("page_indicator", "invoice_number", "doc_ref", "form_number", "total_pages")
    keys = pkg_keys(signals)
    sent = signals.select(*keys, F.explode(F.array(
        F.struct("page_num", cues.alias("own"), F.lit(None).alias("before")),
        F.struct((F.col("page_num") + 1).alias("page_num"), F.lit(None).alias("own"), cues.alias("before")))).alias("s"))
    j = (sent.groupBy(*keys, F.col("s.page_num").alias("page_num"))
         .agg(F.max("s.own").alias("own"), F.max("s.before").alias("p")).where(F.col("own").isNotNull())
         .select(*keys, "page_num", "own.*", F.col("p.invoice_number").alias("p_inv"), F.col("p.doc_ref").alias("p_ref"),
                 F.col("p.form_number").alias("p_form")))
    ind = F.col("page_indicator")
    first_of = ind.rlike(r"^([Pp]age\s+1\s*(/|of)|-\s*1\s*/)")
    cont = ind.rlike(r"^[Pp]age\s+0*([2-9]|[1-9]\d+)\s*(/|of)|^-\s*0*([2-9]|[1-9]\d+)\s*/")

    def changed(c: str, p: str) -> Column:
        prior = F.coalesce(F.col(p), F.lit(""))
        return (F.col(c) != "") & (prior != "") & (F.col(c) != prior)

    form_new = (F.col("form_number") != "") & (F.col("form_number") != F.coalesce(F.col("p_form"), F.lit("")))
    change = changed("invoice_number", "p_inv") | changed("doc_ref", "p_ref") | form_new
    start = (F.col("page_num") == 1) | first_of | (~cont & change)
    return j.select(*keys, "page_num", "total_pages", start.alias("is_start"))


def starts_per_package(flags: DataFrame) -> DataFrame:
    """Boundary set per package from per-page start flags (page 1 always included)."""
    return flags.groupBy(*pkg_keys(flags)).agg(
        F.max("total_pages").alias("total_pages"),
        F.array_sort(F.array_union(F.array(F.lit(1)), F.collect_set(F.when(F.col("is_start"), F.col("page_num")))))
        .alias("predicted_starts"))
