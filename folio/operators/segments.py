"""Split segments, page-to-document assignment and split/archive outcomes (SEG1-6, WIN3-5, AGG12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.common import KEYS
from folio.functions.metrics import canonical_starts, to_documents
from folio.operators.state import event_rows, guarded_update

# Event detail of a blocked package, output name pattern.
BLOCKED_DETAIL = "needs_review=true and no ground-truth JSON — delivery blocked"
OUT_NAME_FMT = "%s_%03d.pdf"


def split_candidates(split: DataFrame, log: DataFrame) -> DataFrame:
    """SEG1: split rows of packages whose delivery has not started yet."""
    started = log.where(F.col("sftp_delivery_status").isNotNull()).select(*KEYS).distinct()
    return (split.join(started, list(KEYS), "left_anti")
            .withColumn("needs_review", F.coalesce(F.col("needs_review"), F.lit(False))))


def review_block(cand: DataFrame, gt_keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SEG2: (to_split, blocked): needs_review without ground truth is blocked."""
    g = gt_keys.select(*KEYS).distinct().withColumn("has_gt", F.lit(True))
    j = cand.join(g, list(KEYS), "left").withColumn("has_gt", F.coalesce(F.col("has_gt"), F.lit(False)))
    blocked = F.col("needs_review") & ~F.col("has_gt")
    return j.where(~blocked), j.where(blocked)


def blocked_events(blocked: DataFrame, at: Column, run_id: str | None = None) -> DataFrame:
    return event_rows(blocked, "pdf_split", "blocked_needs_review", "pipeline", at,
                      detail=F.lit(BLOCKED_DETAIL), run_id=run_id)


def reconcile_pages(cand: DataFrame, counts: DataFrame) -> DataFrame:
    """SEG3: the physical page count wins; starts are clipped to it and keep page 1."""
    c = counts.select(*[k for k in KEYS if k in counts.columns], F.col("n_pages").alias("_phys"))
    keys = [k for k in KEYS if k in counts.columns and k in cand.columns]
    j = cand.join(c, keys, "left")
    total = F.coalesce(F.col("_phys"), F.col("total_pages"))
    return (j.withColumn("page_count_changed", F.col("_phys").isNotNull() & (F.col("_phys") != F.col("total_pages")))
            .withColumn("total_pages", total)
            .withColumn("predicted_starts", canonical_starts(F.col("predicted_starts"), F.col("total_pages")))
            .drop("_phys"))


def segments(cand: DataFrame, gt_docs: DataFrame | None = None, keys=KEYS) -> DataFrame:
    """SEG4 / WIN3 / WIN4: one row per output document (0-based from/to pages).

    Ground truth, where present, wins: its documents are used with the end
    clipped to the package and documents starting past the end dropped.  Else
    the model starts: each document runs to the page before the next start.  One left join
    and one explode of whichever list applies.
    """
    keys = [k for k in keys if k in cand.columns]
    j = cand.select(*keys, "total_pages", to_documents(F.col("predicted_starts"), F.col("total_pages")).alias("_model"))
    if gt_docs is not None:
        j = j.join(gt_docs.select(*keys, F.col("documents").alias("_human")), keys, "left")
    else:
        j = j.withColumn("_human", F.lit(None).cast(j.schema["_model"].dataType))
    pair = lambda a: F.transform(a, lambda d: F.struct(d["start"].cast("int").alias("start"), d["end"].cast("int").alias("end")))
    docs = j.select(*keys, "total_pages", F.when(F.col("_human").isNotNull(), "ground_truth").otherwise("model").alias("split_source"),
                    F.posexplode(F.coalesce(pair("_human"), pair("_model"))).alias("i", "d"))
    return docs.where(F.col("d.start") <= F.col("total_pages")).select(
        *keys, (F.col("i") + 1).cast("int").alias("doc_index"), (F.col("d.start") - 1).alias("from_page"),
        (F.least(F.col("d.end"), F.col("total_pages")) - 1).alias("to_page"),
        F.format_string(OUT_NAME_FMT, F.col("filename"), F.col("i") + 1).alias("out_name"), "split_source")


PAGE_BLOCK = 64


def page_documents(pages: DataFrame, starts: DataFrame, starts_col: str = "predicted_starts") -> DataFrame:
    """WIN5: the output document (1-based) holding each page.

    Each document [start, end] is cut into the 64-page blocks it spans and joined
    to the pages on (filename, block) with the range as a residual test: a page
    meets at most the documents overlapping its block, so the work stays linear
    even for a package with very many pages and documents (no running sum over
    one huge window, no per-page scan of the whole start list).
    """
    if "total_pages" not in starts.columns:  # bound of the last document
        starts = starts.join(pages.groupBy("filename").agg(F.max("page_num").alias("total_pages")), "filename")
    docs = starts.select("filename", "total_pages", F.posexplode(F.col(starts_col)).alias("i", "start"),
                         F.col(starts_col).alias("_s"))
    docs = docs.select("filename", (F.col("i") + 1).cast("int").alias("doc_index"), "start",
                       F.coalesce(F.get("_s", F.col("i") + 1) - 1, F.col("total_pages")).alias("end"))
    blk = lambda c: F.floor(c / PAGE_BLOCK).cast("int")
    d = docs.where(F.col("end") >= F.col("start")).select(
        "*", F.explode(F.sequence(blk(F.col("start")), blk(F.col("end")))).alias("_blk"))
    p = pages.withColumn("_blk", blk(F.col("page_num")))
    j = p.join(d.select("filename", "_blk", "doc_index", "start", "end"), ["filename", "_blk"])
    return (j.where((F.col("page_num") >= F.col("start")) & (F.col("page_num") <= F.col("end")))
            .drop("_blk", "start", "end"))


def split_summary(segs: DataFrame) -> DataFrame:
    """AGG12: packages and documents per split source."""
    return segs.groupBy("split_source").agg(F.countDistinct("filename").alias("n_packages"),
                                            F.count(F.lit(1)).alias("n_documents"))


def apply_split_outcome(log: DataFrame, ok: DataFrame, err: DataFrame, at: Column,
                        run_id: str | None = None) -> DataFrame:
    """SEG5: split -> delivery pending with its output folder and reconciled page count;
    failures -> error at pdf_split, only for rows still 'done'."""
    ok_t = ok.select(*KEYS, "output_folder", "n_pages")
    a = guarded_update(log, ok_t, {"sftp_delivery_status": F.lit("pending"),
                                   "sftp_target_folder": F.col("u_output_folder"),
                                   "n_pages": F.coalesce(F.col("u_n_pages"), F.col("n_pages")),
                                   "completed_at": at}, run_id=run_id).drop("updated")
    err_t = err.select(*KEYS, F.substring("error", 1, 400).alias("error"))
    return guarded_update(a, err_t, {"status": F.lit("error"), "error_message": F.col("u_error"),
                                     "error_stage": F.lit("pdf_split"), "completed_at": at},
                          guard=F.col("status") == "done", run_id=run_id)


def archive_outcome(tasks: DataFrame, manifest: DataFrame, root: str = "") -> DataFrame:
    """SEG6 (plan): per split package, where the original is: moved from the inbox,
    already archived by an earlier run, or missing from both (an error)."""
    inbox = manifest.where(F.col("volume") == "inbox").select(*KEYS).distinct().withColumn("_in", F.lit(True))
    arch = manifest.where(F.col("volume") == "archive").select(*KEYS).distinct().withColumn("_ar", F.lit(True))
    j = tasks.select(*KEYS).distinct().join(inbox, list(KEYS), "left").join(arch, list(KEYS), "left")
    dest = F.concat(F.lit(f"{root}/archive/"), F.col("day_id"), F.lit("/"), F.col("filename"), F.lit(".pdf"))
    state = (F.when(F.col("_in").isNotNull(), F.lit("moved")).when(F.col("_ar").isNotNull(), F.lit("already_archived"))
             .otherwise(F.lit("missing")))
    return j.select(*KEYS, state.alias("archive_state"),
                    F.when(state != "missing", dest).alias("archived_path"))


def apply_archive(log: DataFrame, outcome: DataFrame, run_id: str | None = None) -> DataFrame:
    """SEG6: record archived_path for packages moved or already archived."""
    t = outcome.where(F.col("archived_path").isNotNull()).select(*KEYS, "archived_path")
    return guarded_update(log, t, {"archived_path": F.col("u_archived_path")}, run_id=run_id)
