"""Evaluation of predicted boundaries against human ground truth (EVL*, AGG6-8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import metrics as M
from folio.functions.common import KEYS, count_if, pkg_keys
from folio.operators.views import latest_split
from folio.schemas import EVALUATION_RESULTS, conform

METRIC_NAMES = ("exact_match", "n_true_positive", "n_false_positive", "n_false_negative", "precision",
                "recall", "f1", "n_offby1", "tp_tol", "precision_tol", "recall_tol", "f1_tol",
                "gt_is_multidoc", "model_is_multidoc", "multidoc_correct")


def boundary_metrics(df: DataFrame, gt: str = "gt_starts", model: str = "model_starts") -> DataFrame:
    """EVL1-4: per-row metrics; every metric is NULL where the model set is NULL."""
    return M.with_metrics(df, gt, model)


def build_ground_truth(df: DataFrame, starts: str = "gt_starts") -> DataFrame:
    """EVL6 / SNK7: canonical ground-truth payload.

    Starts are clipped to the package, page 1 is added, documents are derived
    from the starts.  ``is_multidoc`` keeps a given value (the annotator may
    override it) and defaults to "more than one start".
    """
    canon = M.canonical_starts(F.col(starts), F.col("total_pages"))
    given = F.col("is_multidoc") if "is_multidoc" in df.columns else F.lit(None).cast("boolean")
    out = df.withColumn("predicted_starts", canon)
    return out.select(
        *[c for c in df.columns if c not in (starts, "is_multidoc", "predicted_starts")],
        F.coalesce(given, F.size("predicted_starts") > 1).alias("is_multidoc"),
        "predicted_starts",
        F.size("predicted_starts").alias("n_documents"),
        M.to_documents(F.col("predicted_starts"), F.col("total_pages")).alias("documents"),
        F.lit(1).alias("schema_version"),
    )


def evaluate(gt: DataFrame, prediction: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """EVL5: ground truth left-joined with the (latest) prediction, plus metrics.

    ``gt`` has keys, total_pages, gt_starts[, is_multidoc]; ``prediction`` has
    keys, model_starts[, model_used]; the keys default to the package key that both carry.  Rows without a prediction keep NULL metrics.
    """
    g = gt
    if "is_multidoc" not in g.columns:
        g = g.withColumn("is_multidoc", F.size(M.normalize(F.col("gt_starts"))) > 1)
    j = g.join(prediction, list(keys or pkg_keys(g, prediction)), "left")
    # gt_is_multidoc is the annotator's flag, present with or without a prediction.
    ev = boundary_metrics(j).drop("gt_is_multidoc").withColumnRenamed("is_multidoc", "gt_is_multidoc")
    return ev.withColumn("gt_n_documents", F.size("gt_starts")) \
             .withColumn("model_n_documents", F.size("model_starts"))


def evaluation_rows(gt: DataFrame, split: DataFrame, at: Column) -> DataFrame:
    """EVL5: rows in the evaluation table's layout, from annotated payloads (day_id, filename, folder_id, total_pages,
    predicted_starts, is_multidoc, annotator) and split results (the latest prediction per file)."""
    model = latest_split(split).select(*KEYS, F.col("predicted_starts").alias("model_starts"), "model_used")
    human = gt.select(*KEYS, "folder_id", "total_pages", F.col("predicted_starts").alias("gt_starts"), "is_multidoc", "annotator")
    return conform(evaluate(human, model, KEYS).withColumn("annotated_at", at), EVALUATION_RESULTS)


def _stats_aggs():
    with_model = F.col("model_starts").isNotNull() & F.col("exact_match").isNotNull()
    n = F.count(F.lit(1))
    nm = count_if(with_model)

    def avg4(c: str):
        ok = with_model & F.col(c).isNotNull()
        total = F.sum(F.when(ok, M.units4(F.col(c)))).cast("bigint")
        cnt = count_if(ok)
        return M.ratio4(F.coalesce(total, F.lit(0)), cnt * 10000).alias(f"avg_{c}")

    n_exact = count_if(with_model & F.col("exact_match"))
    n_multi_ok = count_if(with_model & F.col("multidoc_correct"))
    n_gt_multi = count_if(F.col("gt_is_multidoc"))
    return [
        n.alias("n_annotated"), nm.alias("n_with_model"), (n - nm).alias("n_no_model"),
        n_exact.alias("n_exact"), M.ratio4(n_exact, nm).alias("exact_rate"),
        n_multi_ok.alias("n_multidoc_correct"), M.ratio4(n_multi_ok, nm).alias("multidoc_rate"),
        F.coalesce(F.sum(F.when(with_model, F.coalesce(F.col("n_offby1"), F.lit(0)))), F.lit(0))
        .cast("bigint").alias("n_offby1_total"),
        avg4("precision"), avg4("recall"), avg4("f1"), avg4("f1_tol"),
        n_gt_multi.alias("n_gt_multidoc"), (n - n_gt_multi).alias("n_gt_single"),
    ]


def eval_stats(ev: DataFrame) -> DataFrame:
    """AGG7: dashboard totals over evaluation rows (one row; 0.0 where empty)."""
    return ev.agg(*_stats_aggs())


def eval_stats_grouped(ev: DataFrame) -> DataFrame:
    """AGG8: the same totals overall, for multidoc and for single (NULL label = single),
    as one grouping-sets aggregation instead of three passes."""
    b = ev.withColumn("bucket", F.when(F.col("gt_is_multidoc") == F.lit(True), "multidoc").otherwise("single"))
    r = b.rollup("bucket").agg(*_stats_aggs(), F.grouping("bucket").alias("_g"))
    return r.select(F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.col("bucket")).alias("bucket"),
                    *[c for c in r.columns if c not in ("bucket", "_g")])


def gate_metrics(ev: DataFrame) -> DataFrame:
    """AGG6: per batch metrics over evaluated rows that have a model prediction."""
    m = ev.where(F.col("model_starts").isNotNull())
    n = F.count(F.lit(1))

    def avg(c: str):
        return (F.sum(M.units4(F.col(c))).cast("double") / (F.count(F.col(c)) * F.lit(10000.0))).alias(f"avg_{c}")

    return m.groupBy("day_id").agg(
        n.alias("n_evaluated"),
        (count_if(F.col("exact_match")).cast("double") / n).alias("exact_match_rate"),
        (count_if(F.col("multidoc_correct")).cast("double") / n).alias("multidoc_rate"),
        avg("precision"), avg("recall"), avg("f1"), avg("f1_tol"),
    )


def worklist(sample: DataFrame, gt: DataFrame) -> DataFrame:
    """EVL7: each sampled file flagged annotated (ground truth exists) or pending."""
    done = gt.select("day_id", "filename").distinct().withColumn("annotated", F.lit(True))
    return (sample.select("day_id", "filename").join(done, ["day_id", "filename"], "left")
            .withColumn("annotated", F.coalesce(F.col("annotated"), F.lit(False))))


def gate_state(sample: DataFrame, gt: DataFrame) -> DataFrame:
    """EVL8: per batch n_sampled, n_annotated, n_missing, complete.

    The missing files themselves are the ``annotated = false`` rows of
    ``worklist``; they are not gathered into one list per batch.
    """
    one = lambda df, n, done: df.select("day_id", "filename", F.lit(n).cast("bigint").alias("n"), F.lit(done).cast("bigint").alias("done"))
    files = (one(sample, 1, 0).unionByName(one(gt.dropna(subset=["day_id", "filename"]), 0, 1))
             .groupBy("day_id", "filename").agg(F.sum("n").alias("n"), F.max("done").alias("done")).where("n > 0"))
    return (files.groupBy("day_id").agg(F.sum("n").alias("n_sampled"), F.sum(F.col("n") * F.col("done")).alias("n_annotated"))
            .withColumn("n_missing", F.col("n_sampled") - F.col("n_annotated"))
            .withColumn("complete", (F.col("n_sampled") > 0) & (F.col("n_missing") == 0)))


def delivery_allowed(batches: DataFrame, gate: DataFrame) -> DataFrame:
    """EVL9: delivery allowed unless a non-empty sample is incomplete (empty passes)."""
    j = batches.select("day_id").distinct().join(gate, "day_id", "left")
    ns = F.coalesce(F.col("n_sampled"), F.lit(0).cast("bigint"))
    return j.select("day_id", ns.alias("n_sampled"),
                    F.coalesce(F.col("n_annotated"), F.lit(0).cast("bigint")).alias("n_annotated"),
                    ((ns == 0) | F.coalesce(F.col("complete"), F.lit(False))).alias("allowed"))


def batch_list(status: DataFrame, manifest: DataFrame, gate: DataFrame) -> DataFrame:
    """EVL10: batches from the tables, inbox and validation listings, with the
    lifecycle refined to 'annotated' when the gate is complete.  Listings are counted per batch; then all facts of a batch
    meet in one aggregation."""
    listed = (manifest.where(F.col("volume").isin("inbox", "validation")).groupBy("day_id")
              .agg(F.sum((F.col("volume") == "inbox").cast("bigint")).alias("n_inbox")))
    facts = (status.select("day_id", F.struct("lifecycle", "has_errors", "n_files").alias("known"))
             .unionByName(listed, allowMissingColumns=True).unionByName(gate.select("day_id", "complete"), allowMissingColumns=True))
    j = (facts.groupBy("day_id").agg(F.max("known").alias("known"), F.max("n_inbox").alias("n_inbox"), F.max("complete").alias("complete"))
         .where("known IS NOT NULL OR n_inbox IS NOT NULL").select("day_id", "known.*", "n_inbox", "complete"))
    life = F.coalesce(F.col("lifecycle"), F.lit("uploaded"))
    life = F.when((life == "awaiting_annotation") & F.coalesce(F.col("complete"), F.lit(False)),
                  F.lit("annotated")).otherwise(life)
    return j.select("day_id", life.alias("lifecycle"),
                    F.coalesce(F.col("has_errors"), F.lit(False)).alias("has_errors"),
                    F.coalesce(F.col("n_files"), F.lit(0).cast("bigint")).alias("n_files"),
                    F.coalesce(F.col("n_inbox"), F.lit(0).cast("bigint")).alias("n_inbox"))
