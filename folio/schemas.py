"""Explicit schemas of the state tables.

Writes always go by name (``conform``) so that a reordered frame can never land
in the wrong column.  Column order below is the table contract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, L, D, B, TS = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                     T.BooleanType(), T.TimestampType())
INT_ARRAY = T.ArrayType(T.IntegerType())


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


PROCESSING_LOG = _struct(
    ("filename", S), ("folder_id", S), ("file_size_mb", D), ("status", S),
    ("error_message", S), ("error_stage", S), ("model_used", S), ("n_pages", I),
    ("n_documents_found", I), ("retry_count", I), ("created_at", TS), ("started_at", TS),
    ("completed_at", TS), ("run_id", S), ("archived_path", S), ("sftp_delivered_at", TS),
    ("sftp_target_folder", S), ("sftp_delivery_status", S), ("sftp_delivery_error", S),
    ("day_id", S),
)

PARSED_DOCUMENTS = _struct(
    ("filename", S), ("folder_id", S), ("source_path", S), ("file_size_mb", D),
    ("n_pages", I), ("parsed_content", S), ("parsed_at", TS), ("run_id", S), ("day_id", S),
)

SPLIT_RESULTS = _struct(
    ("filename", S), ("folder_id", S), ("total_pages", I), ("predicted_starts", INT_ARRAY),
    ("n_documents", I), ("model_used", S), ("fallback_used", B), ("verification_applied", B),
    ("processing_timestamp", TS), ("run_id", S), ("day_id", S), ("needs_review", B),
    ("boundary_source", S),
)

PAGE_SIGNALS = _struct(
    ("filename", S), ("page_num", I), ("total_pages", I), ("first_element", S), ("header", S),
    ("doc_ref", S), ("page_indicator", S), ("form_number", S), ("invoice_number", S),
    ("footer_pagination", S), ("text_start", S), ("text_end", S), ("page_block", S),
    ("run_id", S), ("day_id", S),
)

PACKAGE_SUMMARIES = _struct(
    ("filename", S), ("folder_id", S), ("total_pages", I), ("package_summary", S),
    ("run_id", S), ("day_id", S),
)

LLM_RESPONSES = _struct(
    ("filename", S), ("stage", S), ("model_used", S), ("prompt_token_bucket", S),
    ("raw_response", S), ("error_message", S), ("parsed_starts", INT_ARRAY),
    ("is_fallback", B), ("processing_timestamp", TS), ("run_id", S), ("day_id", S),
)

RUN_HISTORY = _struct(
    ("run_id", S), ("job_run_id", S), ("started_at", TS), ("completed_at", TS), ("status", S),
    ("n_total", L), ("n_success", L), ("n_skipped", L), ("n_error", L),
    ("primary_model", S), ("fallback_model", S), ("duration_min", D), ("notes", S),
)

PIPELINE_EVENTS = T.StructType([
    T.StructField("event_id", S, False), T.StructField("run_id", S), T.StructField("day_id", S),
    T.StructField("stage", S, False), T.StructField("event_type", S, False),
    T.StructField("filename", S), T.StructField("folder_id", S), T.StructField("old_status", S),
    T.StructField("new_status", S), T.StructField("detail", S), T.StructField("error_message", S),
    T.StructField("actor", S, False), T.StructField("event_ts", TS, False),
])

EVALUATION_RESULTS = _struct(
    ("filename", S), ("folder_id", S), ("day_id", S), ("total_pages", I),
    ("gt_starts", INT_ARRAY), ("gt_n_documents", I), ("gt_is_multidoc", B),
    ("model_starts", INT_ARRAY), ("model_n_documents", I), ("model_used", S),
    ("exact_match", B), ("n_true_positive", I), ("n_false_positive", I),
    ("n_false_negative", I), ("precision", D), ("recall", D), ("f1", D), ("n_offby1", I),
    ("precision_tol", D), ("recall_tol", D), ("f1_tol", D), ("multidoc_correct", B),
    ("annotator", S), ("annotated_at", TS),
)

# Only these paths of the parsed document tree are read.
PARSED_TREE = T.StructType([T.StructField("document", T.StructType([
    T.StructField("elements", T.ArrayType(T.StructType([
        T.StructField("id", I), T.StructField("type", S), T.StructField("content", S),
        T.StructField("bbox", T.ArrayType(T.StructType([T.StructField("page_id", I)]))),
    ]))),
]))])

GT_DOCUMENT = _struct(("start", I), ("end", I), ("type", S))
GROUND_TRUTH = _struct(
    ("filename", S), ("folder_id", S), ("day_id", S), ("total_pages", I),
    ("is_multidoc", B), ("predicted_starts", INT_ARRAY), ("n_documents", I),
    ("documents", T.ArrayType(GT_DOCUMENT)), ("annotator", S), ("annotated_at", S),
    ("schema_version", I),
)

# Manifest: one row per listed file.
MANIFEST = _struct(("volume", S), ("day_id", S), ("filename", S), ("ext", S), ("size", L))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema`` by name; absent columns become typed NULLs."""
    have = set(df.columns)
    cols: list[Column] = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
