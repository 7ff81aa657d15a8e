"""The split stage as one job: parsed documents -> signals -> predictions -> split_results.

Composition of the operators in the order the reference runs them.  Every model
call is followed by ``cut_lineage`` (a table in the shared checkpoint folder),
so retries, lost executors or a second action never call a model twice.
With an answer store (``sources.answers``) a later run does not call twice either.
Predictors are plain callables ``(prompt, max_tokens) -> text`` run in Arrow
batches; their failures are data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import prompt_text as P
from folio.functions.common import pkg_keys
from folio.operators import boundaries as BD
from folio.operators import prompts as PR
from folio.operators import run_events as RE
from folio.operators import signals as SG
from folio.operators.state import event_rows, mark_done
from folio.session import ship
from folio.sources.answers import AnswerStore
from folio.sources.sinks import cut_lineage

Predictor = Callable[[str, int], str]


def _materialize(df: DataFrame, name: str, on: bool) -> DataFrame:
    return cut_lineage(df, name) if on else df


def split_stage(parsed: DataFrame, predictor: Predictor, fallback: Predictor | None = None,
                verifier: Predictor | None = None, *, run_id: str, day_id: str,
                primary_model: str = "primary", fallback_model: str = "fallback", at: Column | None = None,
                log: DataFrame | None = None, split: DataFrame | None = None, materialize: bool = True,
                partitions: int | None = None, concurrency: int = 1, answers: AnswerStore | None = None,
                waves: int = 1, tries: int = 1, delay: float = 0.0) -> dict[str, DataFrame]:
    """One batch (``day_id``): its files are those of ``parsed`` with that day, or all where it has no day.

    ``split``: existing split results; their files are not sent to a model again.  ``log``: the
    processing log; the result's ``log`` is the batch's log with split files marked done.
    ``partitions`` and ``concurrency`` spread the model calls, ``tries`` and ``delay`` repeat failed ones (see
    ``prompts.invoke``).  ``answers``: a store that all models are asked through, in ``waves`` commits per pass; a run
    after a killed one then calls only what the store lacks.
    """
    at = at if at is not None else F.current_timestamp()
    tag = f"{run_id}-{day_id}"
    spark = parsed.sparkSession
    ship(spark)
    if "day_id" in parsed.columns:
        parsed = parsed.where(F.col("day_id") == day_id)
    if split is not None:
        parsed = parsed.join(split.where(F.col("day_id") == day_id).select("filename").distinct(), "filename", "left_anti")
    signals = _materialize(SG.page_signals(SG.parse_elements(parsed), run_id, day_id), f"{tag}/page_signals", materialize)
    pkg = SG.package_summary(signals, parsed.select(*pkg_keys(parsed), "folder_id") if "folder_id" in parsed.columns else None)
    pkg = _materialize(pkg, f"{tag}/package_summaries", materialize)
    keys = pkg_keys(signals, pkg)

    def call(prompts: DataFrame, fn: Predictor, keys: list[str], name: str, model: str) -> DataFrame:
        how = {"partitions": partitions, "concurrency": concurrency, "tries": tries, "delay": delay}
        told = PR.invoke(prompts, fn, keys, **how) if answers is None else answers.ask(prompts, fn, keys, model, waves=waves, **how)
        return _materialize(PR.unpack_response(told), f"{tag}/{name}", materialize)

    # single call: primary, then fallback for failures
    plan = PR.prompt_plan(pkg).withColumn("prompt", PR.primary_prompt(F.col("package_summary")))
    prim = PR.with_parsed(call(plan, predictor, [*keys, "total_pages", "token_bucket"], "primary", primary_model))
    _, failures = PR.split_outcomes(prim)
    fb_plan = BD.fallback_prompts(plan, failures)
    fb = PR.with_parsed(call(fb_plan, fallback or predictor, [*keys, "total_pages", "token_bucket"], "fallback", fallback_model))
    single = BD.resolve_single(prim, fb)

    # chunked: packages above the single-call limit
    chunks = PR.chunk_plan(pkg.select(*keys, "total_pages")).join(PR.chunk_text(signals), [*keys, "chunk_idx"])
    chunks = chunks.withColumn("prompt", PR.chunk_prompt(F.col("chunk_start"), F.col("chunk_end"),
                                                         F.col("total_pages"), F.col("chunk_summary")))
    chunks = chunks.withColumn("max_tokens", PR.max_tokens(F.col("token_bucket")))
    cresp = call(chunks, predictor, [*keys, "total_pages", "chunk_idx", "chunk_start", "chunk_end", "token_bucket"], "chunks", primary_model)
    cparsed = PR.with_parsed(cresp, out="chunk_starts")
    merged = BD.merge_chunks(cparsed)
    large = pkg.where(F.col("total_pages") > P.MAX_PAGES_SINGLE_CALL)
    resolved = _materialize(BD.combine(single, merged, BD.large_missing(large, merged)), f"{tag}/resolved", materialize)

    # verification of proposed boundaries
    batch = BD.with_verify_prompt(BD.verify_batch(BD.verify_windows(BD.proposed(resolved), signals)))
    if verifier is not None:
        vb = batch.withColumn("max_tokens", F.lit(P.TOKENS_VERIFY))
        answers = call(vb, verifier, [*keys, "total_pages"], "verify", f"{primary_model}/verify")
        vr = answers.select(*keys, F.col("raw_response").alias("verify_response"),
                       F.col("error_message").alias("verify_error"))
        corrected = BD.apply_corrections(batch.join(vr, keys))
    else:
        answers = None
        corrected = batch.withColumn("verify_response", F.lit(None).cast("string")) \
                         .withColumn("verify_error", F.lit("no verifier configured"))
        corrected = BD.apply_corrections(corrected)

    responses = (PR.log_responses(prim, "primary_pass", primary_model, False, run_id, day_id, at)
           .unionByName(PR.log_responses(fb, "retry_fallback", fallback_model, True, run_id, day_id, at))
           .unionByName(PR.log_responses(cparsed.withColumnRenamed("chunk_starts", "parsed_starts"), "chunk",
                                         primary_model, False, run_id, day_id, at)))
    results = BD.split_results(resolved, corrected, responses, pkg, run_id, day_id, at)
    results = _materialize(results, f"{tag}/split_results", materialize)
    if answers is not None:
        responses = responses.unionByName(PR.log_responses(answers, "verification", primary_model, False, run_id, day_id, at))
    review = BD.review_events(resolved)
    events = event_rows(review.withColumn("day_id", F.lit(day_id)), "split", "needs_review",
                        "pipeline", at, detail=F.col("detail"), run_id=run_id)
    n = RE.tally(spark, day_id, n_to_split=pkg, n_split=results, n_failed=resolved.where(F.col("boundary_source") == "ultimate_fallback"))
    status = F.when(F.col("n_to_split") == 0, "NO_FILES_TO_SPLIT").when(F.col("n_failed") > 0, "partial_failure").otherwise("success")
    events = (events.unionByName(RE.run_event(spark, "split", "run_started", day_id, at, run_id))
              .unionByName(event_rows(n, "split", "status_change", "pipeline", at, detail=RE.text(F.col("n_split"), " files split"),
                                      run_id=run_id, old_status=F.lit("parsed"), new_status=F.lit("done")))
              .unionByName(RE.counted_event(n, "split", "run_completed", at, run_id, RE.text("n_results=", F.col("n_split")), status)))
    out = {"page_signals": signals, "package_summaries": pkg, "responses": responses, "resolved": resolved,
           "split_results": results, "events": events}
    if log is not None:
        out["log"] = mark_done(log.where(F.col("day_id") == day_id), results, run_id, at).drop("updated")
    return out
