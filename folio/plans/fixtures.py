"""Adapters: state-table shaped relations derived from the driver's tables.

The reference keeps its state in a handful of tables (processing log, split
results, events, parsed documents ...).  The test data is TPC-H shaped, so each
adapter below derives one state relation from it with plain DataFrame
expressions.  The same relations are written as SQL in ``plans/oracle_fixtures.py`` so
an independent engine can check every query.  All adapters are lazy and
scale with their input tables; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMM")


def _pkg_filename(custkey: Column) -> Column:
    return F.concat((custkey - custkey % 64).cast("string"), F.lit("_PKG"),
                    (custkey - custkey % 16).cast("string"))


def fx_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """processing_log rows; about 2.3 rows per (day_id, filename) on purpose."""
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    m16 = k % 16
    status = (F.when(m16 == 0, "pending").when(m16 == 1, "parsing").when(m16 == 2, "parsed")
              .when(m16 == 3, "error").when(m16 == 4, "skipped").when(m16 == 5, "manual")
              .otherwise("done"))
    sftp = F.when(m16 > 5, F.when(c % 5 == 0, "pending").when(c % 5 == 1, "delivered")
                  .when(c % 5 == 2, "delivered").when(c % 5 == 3, "failed")
                  .otherwise(F.when(k % 2 == 0, "deferred")))
    return o.select(
        _day_id(F.col("o_orderdate")).alias("day_id"),
        _pkg_filename(c).alias("filename"),
        (c - c % 64).cast("string").alias("folder_id"),
        k.alias("log_seq"),
        F.floor(F.col("o_totalprice") * 300).cast("bigint").alias("length_bytes"),
        status.alias("status"),
        F.when(m16 == 3, F.lit("boom")).alias("error_message"),
        F.when(k % 32 == 3, F.lit("parsing")).when(m16 == 3, F.lit("pdf_split")).alias("error_stage"),
        (1 + k % 60).cast("int").alias("n_pages"),
        (k % 4).cast("int").alias("retry_count"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("started_at"),
        F.when(m16 > 1, F.col("o_orderdate")).alias("completed_at"),
        sftp.alias("sftp_delivery_status"),
        F.when((m16 > 5) & (c % 5).isin(1, 2), F.col("o_orderdate")).alias("sftp_delivered_at"),
    )


def fx_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """split_results rows (without the array column), one per order.  Some name files that the log does
    not have, so logged files without a split result come from a join that finds nothing."""
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    source = (F.when(k % 13 == 0, "ultimate_fallback").when(k % 5 == 0, "fallback")
              .when(k % 7 == 0, "chunked").otherwise("primary"))
    other = F.when((k % 16 > 5) | (k % 3 == 0), F.lit("")).otherwise(F.lit("_X"))
    return o.select(
        _day_id(F.col("o_orderdate")).alias("day_id"),
        F.concat(_pkg_filename(c), other).alias("filename"),
        (c - c % 64).cast("string").alias("folder_id"),
        k.alias("split_seq"),
        (1 + k % 60).cast("int").alias("total_pages"),
        (1 + k % 7).cast("int").alias("n_documents"),
        F.col("o_orderdate").alias("processing_timestamp"),
        (k % 13 == 0).alias("needs_review"),
        source.alias("boundary_source"),
    )


def fx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pipeline_events rows; day_id values overlap those of ``fx_log``."""
    e = table(spark, sf_dir, "events")
    i, et = F.col("event_id"), F.col("event_type")
    stage = (F.when(i % 5 == 0, "parse").when(i % 5 == 1, "split").when(i % 5 == 2, "check_export")
             .when(i % 5 == 3, "pdf_split").otherwise("sftp_upload"))
    etype = (F.when(et == "error", "error").when(et == "click", "needs_review")
             .when(et == "purchase", "delivered").when(et == "view", "deferred")
             .otherwise(F.when(i % 3 == 0, "quarantined").when(i % 3 == 1, "awaiting_annotation")
                        .otherwise("run_completed")))
    new_status = F.when((et == "signup") & (i % 3 == 2),
                        F.when(i % 2 == 0, "success").otherwise("partial_failure"))
    return e.select(
        i.cast("string").alias("event_id"),
        F.concat(F.lit("run-"), (i % 20).cast("string")).alias("run_id"),
        F.concat((1995 + i % 7).cast("string"), F.lpad((1 + i % 12).cast("string"), 2, "0")).alias("day_id"),
        stage.alias("stage"),
        etype.alias("event_type"),
        new_status.alias("new_status"),
        F.concat(F.col("user_id").cast("string"), F.lit("_PKG")).alias("filename"),
        F.col("ts").alias("event_ts"),
    )


#: Tasks per file split when rows are dealt by package: a row becomes a few kilobytes of page texts in the same task.
TASKS_PER_SPLIT = 24


def by_package(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows by package into tasks that grow in number with the files read.  The number is given, because adaptive
    coalescing goes by the bytes shuffled here and what is made of them in the same task is many times that."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_SPLIT * df.rdd.getNumPartitions())
    return df.repartition(n, *keys)


def fx_pages(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Page skeleton: one order is one package, one line item one page.  Rows are shuffled by package once; what
    is later grouped by package, or by package and page, needs no further shuffle.  ``dealt`` (for page texts): see ``by_package``."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    li = table(spark, sf_dir, "lineitem").select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("_ORDER")).alias("filename"), *order, "l_returnflag", "l_linestatus")
    li = by_package(li, "filename") if dealt else li
    w = Window.partitionBy("filename").orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # same sort, one window pass
    return li.select(
        "filename",
        F.row_number().over(w).cast("int").alias("page_num"),
        F.count(F.lit(1)).over(whole).cast("int").alias("total_pages"),
        "l_returnflag", "l_linestatus", "l_suppkey",
    )


def fx_elements(spark: SparkSession, sf_dir: str, pages: DataFrame | None = None) -> DataFrame:
    """Exploded parsed elements: a title on open pages, a text element on every page.

    Both elements of a page come out of one pass over the pages (an explode of
    a two-slot array; the title slot is empty on pages that are not open).
    """
    p = pages if pages is not None else fx_pages(spark, sf_dir)
    pn, tp = F.col("page_num"), F.col("total_pages")
    title = F.when(F.col("l_linestatus") == "O", F.struct(
        ((pn - 1) * 2).cast("int").alias("element_id"), F.lit("title").alias("element_type"),
        F.concat(F.lit("Commercial "), F.col("l_returnflag"), F.lit(" Form CBP 7501")).alias("content")))
    text = F.struct(
        (1 + (pn - 1) * 2).cast("int").alias("element_id"), F.lit("text").alias("element_type"),
        F.concat(F.lit("invoice number: INV-"), F.col("l_suppkey").cast("string"), F.lit(" rev "),
                 F.col("l_returnflag"), F.lit(" Page "), pn.cast("string"), F.lit(" of "),
                 tp.cast("string"), F.lit(" end Page "), pn.cast("string"), F.lit("/"),
                 tp.cast("string")).alias("content"))
    e = p.select("filename", "page_num", F.explode(F.array(title, text)).alias("e")).where(F.col("e").isNotNull())
    return e.select("filename", "page_num", "e.element_id", "e.element_type", "e.content")


def _change_starts(pages: DataFrame, flag: str) -> DataFrame:
    w = Window.partitionBy("filename").orderBy("page_num")
    prev = F.lag(flag).over(w)
    return (pages.select("filename", "page_num", "total_pages", flag, prev.alias("prev"))
            .where((F.col("page_num") == 1) | (F.col(flag) != F.col("prev")))
            .select("filename", "page_num", "total_pages"))


def fx_gt_starts(spark: SparkSession, sf_dir: str, pages: DataFrame | None = None) -> DataFrame:
    """Human boundaries: a page starts a document when its return flag changes."""
    return _change_starts(pages if pages is not None else fx_pages(spark, sf_dir), "l_returnflag")


def fx_model_starts(spark: SparkSession, sf_dir: str, pages: DataFrame | None = None) -> DataFrame:
    """Predicted boundaries: a page starts a document when its line status changes."""
    return _change_starts(pages if pages is not None else fx_pages(spark, sf_dir), "l_linestatus")


def fx_long_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long packages: one supplier is one package, so most exceed 50 pages."""
    li = table(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_suppkey").orderBy(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return li.select(
        F.concat(F.col("l_suppkey").cast("string"), F.lit("_LONG")).alias("filename"),
        F.row_number().over(w).cast("int").alias("page_num"),
        F.count(F.lit(1)).over(whole).cast("int").alias("total_pages"),
        F.concat(F.lit("block "), F.col("l_orderkey").cast("string")).alias("page_block"),
    )


def fx_long_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packages of ``fx_long_pages`` with their page totals: counted, without ordering the pages."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.concat(F.col("l_suppkey").cast("string"), F.lit("_LONG")).alias("filename")).agg(
        F.count(F.lit(1)).cast("int").alias("total_pages"))


def fx_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw model output text: eight response shapes, one eighth each."""
    return fx_responses_from(table(spark, sf_dir, "orders"))


def fx_responses_from(o: DataFrame, shift: int = 0) -> DataFrame:
    m8 = (F.col("o_orderkey") + shift) % 8
    raw = (F.when(m8 == 0, F.lit('{"predicted_starts": [1, 3, 9]}'))
           .when(m8 == 1, F.lit('```json\n{"predicted_starts": [9, 3, 3]}\n```'))
           .when(m8 == 2, F.lit('sure: {"predicted_starts": [2, "5", "99999999999", 1e20, 7.9]} done'))
           .when(m8 == 3, F.lit("{bad"))
           .when(m8 == 4, F.lit("{}"))
           .when(m8 == 5, F.lit('{"predicted_starts": null}'))
           .when(m8 == 6, F.lit("no json")))
    return o.select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit("_ORDER")).alias("filename"),
        (1 + F.col("o_orderkey") % 60).cast("int").alias("total_pages"),
        raw.alias("raw_response"),
        F.when(m8 == 7, F.lit("timeout")).alias("error_message"),
    )


def fx_fallback_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fallback-model text: the same eight shapes as ``fx_responses``, shifted by three."""
    return fx_responses_from(table(spark, sf_dir, "orders"), shift=3)


def fx_manifest(spark: SparkSession, sf_dir: str, log: DataFrame | None = None) -> DataFrame:
    """Directory listings per volume and batch, derived from the log keys."""
    lg = log if log is not None else fx_log(spark, sf_dir)
    k = lg.select("day_id", "filename",
                  F.substring("day_id", 5, 2).cast("int").alias("m"),
                  F.col("folder_id").cast("bigint").alias("f")).distinct()
    m, f = F.col("m"), F.col("f")
    # Four fixed volumes: a literal relation of four rows, expressed as an explode.
    vols = F.explode(F.array(*[F.lit(v) for v in ("inbox", "validation", "ground_truth", "archive")]))
    v = F.col("volume")
    keep = ((v == "inbox") | ((v == "archive") & (m == 12))
            | ((v == "validation") & (m % 3 == 0) & (f % 192 == 0))
            | ((v == "ground_truth") & (m % 3 == 0) & (f % 192 == 0) & ((m == 6) | (f % 128 == 0))))
    return (k.select("day_id", "filename", "m", "f", vols.alias("volume"))
            .where(keep).select("volume", "day_id", "filename"))


def fx_transfer(spark: SparkSession, sf_dir: str, pages: DataFrame | None = None) -> DataFrame:
    """Delivery tasks with the local and remote listing facts per output PDF."""
    p = pages if pages is not None else fx_pages(spark, sf_dir)
    pn, s = F.col("page_num"), F.col("l_suppkey")
    remote = (F.when((pn + s) % 37 == 0, F.lit(None).cast("bigint"))
              .when((pn + s) % 29 == 0, F.lit(7).cast("bigint"))
              .otherwise((1000 + pn).cast("bigint")))
    return p.select(
        "filename",
        F.concat("filename", F.lit("_"), F.lpad(pn.cast("string"), 3, "0"), F.lit(".pdf")).alias("out_name"),
        s.cast("string").alias("folder_id"),
        (1000 + pn).cast("bigint").alias("local_size"),
        remote.alias("remote_size"),
        (s % 11 != 0).alias("remote_folder_exists"),
        F.when((pn + s) % 23 == 0, F.concat(F.lit("conn reset "), F.repeat(F.lit("x"), (s % 400).cast("int")))).alias("upload_error"),
    )


def fx_remote_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folders that ``fx_transfer`` says exist remotely, from the line items alone."""
    s = F.col("l_suppkey")
    return table(spark, sf_dir, "lineitem").where(s % 11 != 0).select(s.cast("string").alias("folder_id")).distinct()


def fx_eval_sets(spark: SparkSession, sf_dir: str, pages: DataFrame | None = None) -> DataFrame:
    """Ground-truth and model boundary arrays per package (some without a model set).

    Both boundary sets come from one window pass and one aggregation over the
    pages (``fx_gt_starts`` / ``fx_model_starts`` are the same rules one at a time).
    """
    p = pages if pages is not None else fx_pages(spark, sf_dir)
    w = Window.partitionBy("filename").orderBy("page_num")
    first = F.col("page_num") == 1
    flagged = p.select(
        "filename", "page_num", "total_pages",
        (first | (F.col("l_returnflag") != F.lag("l_returnflag").over(w))).alias("gt_start"),
        (first | (F.col("l_linestatus") != F.lag("l_linestatus").over(w))).alias("model_start"))
    agg = flagged.groupBy("filename").agg(
        F.max(F.when(F.col("gt_start"), F.col("total_pages"))).alias("total_pages"),
        F.sort_array(F.collect_list(F.when(F.col("gt_start"), F.col("page_num")))).alias("gt_starts"),
        F.sort_array(F.collect_list(F.when(F.col("model_start"), F.col("page_num")))).alias("model_starts"))
    no_model = F.substring("filename", -7, 7) == "7_ORDER"
    return agg.select("filename", "total_pages", "gt_starts",
                      F.when(~no_model, F.col("model_starts")).alias("model_starts"))


def fx_parsed(spark: SparkSession, sf_dir: str, elements: DataFrame | None = None) -> DataFrame:
    """One parsed-document JSON string per package."""
    el = elements if elements is not None else fx_elements(spark, sf_dir, fx_pages(spark, sf_dir, dealt=True))
    j = F.concat(F.lit('{"id":'), F.col("element_id").cast("string"), F.lit(',"type":"'),
                 F.col("element_type"), F.lit('","content":"'), F.col("content"),
                 F.lit('","bbox":[{"page_id":'), (F.col("page_num") - 1).cast("string"), F.lit("}]}"))
    return (el.groupBy("filename")
            .agg(F.sort_array(F.collect_list(F.struct("element_id", j.alias("j")))).alias("items"))
            .select("filename", F.concat(F.lit('{"document":{"elements":['),
                                         F.concat_ws(",", F.transform("items", lambda x: x["j"])),
                                         F.lit("]}}")).alias("parsed_content")))


DOC_PAGE_CHARS = 600


def fx_doc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real text: one document is one package, cut into pages of 600 characters, with all shapes of
    page indicators, form and invoice numbers around it."""
    text = F.coalesce("text", F.lit(""))
    d = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", text.alias("text"),
        F.greatest(F.lit(1), F.ceil(F.length(text) / DOC_PAGE_CHARS)).cast("int").alias("n"))
    p, n = F.col("page_num"), F.col("total_pages")
    pages = d.select("doc_id", "source", "lang", "text", F.col("n").alias("total_pages"),
                     F.explode(F.sequence(F.lit(1), F.col("n"))).alias("page_num"))
    shape = (F.col("doc_id") * 7 + p) % 9
    head = (F.when(shape == 0, F.concat(F.lit("Page "), p, F.lit(" of "), n, F.lit(" ")))
            .when(shape == 1, F.concat(F.lit("- "), p, F.lit(" / "), n, F.lit(" - ")))
            .when(shape == 2, F.lit("Form 3461 "))
            .when(shape == 3, F.concat(F.lit("Form CBP 7512 invoice no: INV-"), F.col("doc_id") % 50, F.lit(" ")))
            .when(shape == 4, F.concat(F.lit("INVOICE # A/1."), p, F.lit(" ")))
            .when(shape == 5, F.concat(F.lit("page "), p, F.lit("/"), n, F.lit("\n"))).otherwise(F.lit("")))
    tail = F.when(p % 4 == 0, F.concat(F.lit("\nPage "), p, F.lit("/ "), n)).otherwise(F.lit(""))
    body = F.substring("text", (p - 1) * DOC_PAGE_CHARS + 1, F.lit(DOC_PAGE_CHARS))
    return pages.select(F.concat(F.col("doc_id").cast("string"), F.lit("_DOC")).alias("filename"), "source", "lang",
                        "page_num", "total_pages", head.alias("head"), body.alias("body"), tail.alias("tail"))


def fx_doc_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One parsed-document JSON text per document, escaped by the JSON writer."""
    p = F.col("page_num")
    box = F.array(F.struct((p - 1).alias("page_id"))).alias("bbox")
    title = F.when(p % 3 == 1, F.struct(
        (2 * (p - 1)).alias("id"), F.when(p % 2 == 1, F.lit("title")).otherwise(F.lit("sectionHeading")).alias("type"),
        F.concat(F.lit('Section "'), "source", F.lit('" \\'), "lang").alias("content"), box))
    text = F.struct((2 * (p - 1) + 1).alias("id"), F.lit("text").alias("type"), F.concat("head", "body", "tail").alias("content"), box)
    pages = fx_doc_pages(spark, sf_dir).select("filename", F.explode(F.array_compact(F.array(title, text))).alias("e"))
    els = pages.groupBy("filename").agg(F.sort_array(F.collect_list("e")).alias("elements"))
    return els.select("filename", F.to_json(F.struct(F.struct("elements").alias("document"))).alias("parsed_content"))
