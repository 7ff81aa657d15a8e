"""Parsed documents -> page elements -> page signals -> package summaries (SRC3, INT5, SIG1-14).

Ordering is made explicit everywhere the reference relies on unordered
``collect_list`` / ``first_value``: page text joins element contents by
element id, the first heading is the lowest-id heading, blocks are ordered by
page number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.common import pkg_keys
from folio.schemas import PARSED_TREE

# Signal patterns and slice lengths of the page signals.
DOC_REF_RE = r"(INV[A-Z]*[\s:# -]*[A-Z0-9-]+)"
PAGE_INDICATOR_RE = r"([Pp]age\s+\d+\s*(/|of)\s*\d+|-\s*\d+\s*/\s*\d+\s*-)"
FORM_NUMBER_RE = r"(Form\s*(?:CBP\s*)?(?:7501|3461|3311|7512|3299))"
INVOICE_NUMBER_RE = r"(?i)invoice\s*(?:no|number|#|:)?\s*[:\s]?\s*([A-Z0-9][A-Z0-9/.-]+)"
FOOTER_PAGINATION_RE = r"([Pp]age\s+\d+\s*/\s*\d+)"
HEADER_LEN, BLOCK_HEADER_LEN, START_LEN, END_LEN, FOOTER_WINDOW = 200, 150, 300, 300, 100
HEADING_TYPES = ("title", "sectionHeading")
MAX_HEADING_ELEMENT_ID = 3

# Pages per partial string when a package summary is assembled in two steps.
SUMMARY_SLAB = 64


def _elements(parsed_content: Column) -> Column:
    return F.from_json(parsed_content, PARSED_TREE)["document"]["elements"]


def n_pages_expr(parsed_content: Column) -> Column:
    """INT5: pages = max(first bbox page_id, missing -> 0) + 1; NULL when no elements.

    One fold over the parsed list (so the JSON is parsed once): it starts at NULL,
    so a missing or empty list stays NULL.
    """
    el_type = PARSED_TREE["document"].dataType["elements"].dataType
    els = F.coalesce(_elements(parsed_content), F.array().cast(el_type))
    top = F.aggregate(els, F.lit(None).cast("int"), lambda acc, e: F.greatest(
        F.coalesce(acc, F.lit(0)), F.coalesce(F.get(e["bbox"], 0)["page_id"], F.lit(0))))
    return top + 1


def parse_elements(parsed: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """SRC3 / SIG1: one row per element with a page; elements without a bbox page are dropped.

    Each row also carries its package's page total (SIG4: the highest element
    page), read from the package's own JSON row, so signals need no extra
    aggregation and join for it.
    """
    keep = keep or tuple(pkg_keys(parsed))
    tree = parsed.select(*keep, _elements(F.col("parsed_content")).alias("_els"))  # parse once
    els = F.col("_els")
    pages = F.transform(els, lambda x: F.get(x["bbox"], 0)["page_id"] + 1)
    e = tree.select(*keep, F.array_max(pages).cast("int").alias("total_pages"), F.explode(els).alias("e"))
    out = e.select(*keep, "total_pages",
                   (F.get(F.col("e.bbox"), 0)["page_id"] + 1).alias("page_num"),
                   F.col("e.type").alias("element_type"),
                   F.col("e.content").alias("content"),
                   F.col("e.id").alias("element_id"))
    return out.where(F.col("page_num").isNotNull())


def page_text(elements: DataFrame) -> DataFrame:
    """SIG2: contents of a page joined by ' ' in element order."""
    return elements.groupBy(*pkg_keys(elements), "page_num").agg(
        F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("element_id", "content"))),
                                     lambda x: x["content"])).alias("full_text"))


def _is_heading() -> Column:
    return F.col("element_type").isin(*HEADING_TYPES) & (F.col("element_id") <= MAX_HEADING_ELEMENT_ID)


def first_heading(elements: DataFrame) -> DataFrame:
    """SIG3: lowest-id title/sectionHeading with element_id <= 3, per page."""
    return (elements.where(_is_heading()).groupBy(*pkg_keys(elements), "page_num")
            .agg(F.min_by("content", "element_id").alias("first_element")))


def total_pages(elements: DataFrame) -> DataFrame:
    """SIG4: package page total = highest page number."""
    return elements.groupBy(*pkg_keys(elements)).agg(F.max("page_num").alias("total_pages"))


def _pages(elements: DataFrame) -> DataFrame:
    """Page text and first heading in one aggregation per (filename, page)."""
    head = _is_heading()
    extra = [F.max("total_pages").alias("total_pages")] if "total_pages" in elements.columns else []
    return elements.groupBy(*pkg_keys(elements), "page_num").agg(*extra,
        F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("element_id", "content"))),
                                     lambda x: x["content"])).alias("full_text"),
        F.min_by(F.when(head, F.col("content")), F.when(head, F.col("element_id"))).alias("first_element"))


def page_signals(elements: DataFrame, run_id: str | None = None, day_id: str | None = None) -> DataFrame:
    """SIG5-12: per-page text signals and the compact page block.

    Each pattern is evaluated once; the block reuses the columns.  Package totals
    are carried from ``parse_elements``; for other element sources they come
    from a per-package aggregate joined back on filename (a skewed package is
    split by adaptive skew-join handling, not gathered into one window task).
    """
    pages = _pages(elements)
    if "total_pages" not in pages.columns:
        pages = pages.join(total_pages(elements), pkg_keys(elements))
    t = F.col("full_text")
    sig = pages.select(
        *pkg_keys(pages), "page_num", "total_pages",
        F.coalesce(F.col("first_element"), F.lit("")).alias("first_element"),
        F.left(t, F.lit(HEADER_LEN)).alias("header"),
        F.left(t, F.lit(BLOCK_HEADER_LEN)).alias("_header150"),
        F.regexp_extract(t, DOC_REF_RE, 0).alias("doc_ref"),
        F.regexp_extract(t, PAGE_INDICATOR_RE, 0).alias("page_indicator"),
        F.regexp_extract(t, FORM_NUMBER_RE, 0).alias("form_number"),
        F.regexp_extract(t, INVOICE_NUMBER_RE, 1).alias("invoice_number"),
        F.regexp_extract(F.right(t, F.lit(FOOTER_WINDOW)), FOOTER_PAGINATION_RE, 0).alias("footer_pagination"),
        F.left(t, F.lit(START_LEN)).alias("text_start"),
        F.right(t, F.lit(END_LEN)).alias("text_end"),
    )
    block = F.concat(
        F.lit("first_element: "), F.col("first_element"), F.lit("\n"),
        F.lit("header: "), F.col("_header150"), F.lit("\n"),
        F.lit("doc_ref: "), F.col("doc_ref"), F.lit("\n"),
        F.lit("page_indicator: "), F.col("page_indicator"), F.lit("\n"),
        F.lit("form_number: "), F.col("form_number"), F.lit("\n"),
        F.lit("invoice_number: "), F.col("invoice_number"), F.lit("\n"),
        F.lit("footer_pagination: "), F.col("footer_pagination"), F.lit("\n"),
        F.lit("text_start: "), F.col("text_start"), F.lit("\n"),
        F.lit("text_end: "), F.col("text_end"))
    out = sig.withColumn("page_block", block).drop("_header150")
    out = out.withColumn("run_id", F.lit(run_id).cast("string"))
    return out if day_id is None or "day_id" in out.columns else out.withColumn("day_id", F.lit(day_id))


def _labelled(page_num: Column, text: Column) -> Column:
    return F.concat(F.lit("=== PAGE "), page_num.cast("string"), F.lit(" ===\n"), text)


def ordered_text(df: DataFrame, keys: list[str], pos: str, text: str, out: str, sep: str = "\n",
                 max_cols: tuple[str, ...] = (), positions: str | None = None) -> DataFrame:
    """Join ``text`` per ``keys`` in ``pos`` order, in two steps so no single task
    sorts every piece of a very large group: slabs of ``SUMMARY_SLAB`` positions
    first, then the slabs in order.  ``max_cols`` are carried along as maxima; ``positions`` names a
    column for the sorted distinct positions."""
    slab = F.floor(F.col(pos) / SUMMARY_SLAB)
    mx = [F.max(c).alias(c) for c in max_cols]
    parts = (df.withColumn("_slab", slab).groupBy(*keys, "_slab")
             .agg(F.concat_ws(sep, F.transform(F.sort_array(F.collect_list(F.struct(F.col(pos), F.col(text)))),
                                               lambda x: x[text])).alias("_part"),
                  F.collect_set(pos).alias("_at"), *mx))
    at = [F.array_sort(F.array_distinct(F.flatten(F.collect_list("_at")))).alias(positions)] if positions else []
    return (parts.groupBy(*keys)
            .agg(F.concat_ws(sep, F.transform(F.sort_array(F.collect_list(F.struct("_slab", "_part"))),
                                              lambda x: x["_part"])).alias(out), *at, *mx))


def page_blocks(signals: DataFrame) -> DataFrame:
    """SIG13 piece by piece: one row (keys, position, text) per page; joined by newlines in the order of the
    positions, a package's rows are its summary.  No row holds more than one page."""
    return signals.select(*pkg_keys(signals), F.col("page_num").alias("position"), _labelled(F.col("page_num"), F.col("page_block")).alias("text"))


def package_summary(signals: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    """SIG13: one text per package, page blocks in page order under ``=== PAGE n ===``."""
    keys = pkg_keys(signals)
    labelled = signals.select(*keys, "page_num", "total_pages",
                              _labelled(F.col("page_num"), F.col("page_block")).alias("_blk"))
    out = ordered_text(labelled, keys, "page_num", "_blk", "package_summary", max_cols=("total_pages",))
    if folders is not None:
        by = pkg_keys(out, folders)
        out = out.join(folders.select(*by, "folder_id"), by)
    return out


def summary_stats(pkg: DataFrame, limit: int = 50) -> DataFrame:
    """SIG14: package count, average / max pages, packages above the single-call limit."""
    return pkg.agg(F.count(F.lit(1)).alias("n_pdfs"),
                   F.avg("total_pages").alias("avg_pages"),
                   F.max("total_pages").alias("max_pages"),
                   F.sum(F.when(F.col("total_pages") > limit, 1).otherwise(0)).cast("bigint").alias("n_large"))
