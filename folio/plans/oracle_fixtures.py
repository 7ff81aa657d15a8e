"""The adapters of ``plans/fixtures.py`` as SQL for the independent oracle engine.

Each oracle query names the adapters it needs (``fx_*``); ``with_fixtures``
prepends them, with their dependencies, as CTEs.  Only the driver tables are
registered as views on the oracle side.
"""

from __future__ import annotations

import re

FX_SQL: dict[str, str] = {
    "fx_log": r"""
SELECT replace(substr(CAST(o_orderdate AS STRING),1,7),'-','') AS day_id,
  concat(CAST(o_custkey - o_custkey % 64 AS STRING), '_PKG', CAST(o_custkey - o_custkey % 16 AS STRING)) AS filename,
  CAST(o_custkey - o_custkey % 64 AS STRING) AS folder_id, o_orderkey AS log_seq,
  CAST(floor(o_totalprice * 300) AS BIGINT) AS length_bytes,
  CASE o_orderkey % 16 WHEN 0 THEN 'pending' WHEN 1 THEN 'parsing' WHEN 2 THEN 'parsed' WHEN 3 THEN 'error'
       WHEN 4 THEN 'skipped' WHEN 5 THEN 'manual' ELSE 'done' END AS status,
  CASE WHEN o_orderkey % 16 = 3 THEN 'boom' END AS error_message,
  CASE WHEN o_orderkey % 32 = 3 THEN 'parsing' WHEN o_orderkey % 16 = 3 THEN 'pdf_split' END AS error_stage,
  CAST(1 + o_orderkey % 60 AS INT) AS n_pages, CAST(o_orderkey % 4 AS INT) AS retry_count,
  o_orderdate AS created_at, o_orderdate AS started_at,
  CASE WHEN o_orderkey % 16 > 1 THEN o_orderdate END AS completed_at,
  CASE WHEN o_orderkey % 16 > 5 THEN CASE o_custkey % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'delivered' WHEN 2 THEN 'delivered'
       WHEN 3 THEN 'failed' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'deferred' END END END AS sftp_delivery_status,
  CASE WHEN o_orderkey % 16 > 5 AND o_custkey % 5 IN (1,2) THEN o_orderdate END AS sftp_delivered_at
FROM orders""",
    "fx_split": r"""
SELECT replace(substr(CAST(o_orderdate AS STRING),1,7),'-','') AS day_id,
  concat(CAST(o_custkey - o_custkey % 64 AS STRING), '_PKG', CAST(o_custkey - o_custkey % 16 AS STRING),
    CASE WHEN o_orderkey % 16 > 5 OR o_orderkey % 3 = 0 THEN '' ELSE '_X' END) AS filename,
  CAST(o_custkey - o_custkey % 64 AS STRING) AS folder_id, o_orderkey AS split_seq, CAST(1 + o_orderkey % 60 AS INT) AS total_pages,
  CAST(1 + o_orderkey % 7 AS INT) AS n_documents, o_orderdate AS processing_timestamp,
  o_orderkey % 13 = 0 AS needs_review,
  CASE WHEN o_orderkey % 13 = 0 THEN 'ultimate_fallback' WHEN o_orderkey % 5 = 0 THEN 'fallback' WHEN o_orderkey % 7 = 0 THEN 'chunked' ELSE 'primary' END AS boundary_source
FROM orders""",
    "fx_events": r"""
SELECT CAST(event_id AS STRING) AS event_id, concat('run-', CAST(event_id % 20 AS STRING)) AS run_id,
  concat(CAST(1995 + event_id % 7 AS STRING), lpad(CAST(1 + event_id % 12 AS STRING),2,'0')) AS day_id,
  CASE event_id % 5 WHEN 0 THEN 'parse' WHEN 1 THEN 'split' WHEN 2 THEN 'check_export' WHEN 3 THEN 'pdf_split' ELSE 'sftp_upload' END AS stage,
  CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'needs_review' WHEN 'purchase' THEN 'delivered' WHEN 'view' THEN 'deferred'
    ELSE CASE event_id % 3 WHEN 0 THEN 'quarantined' WHEN 1 THEN 'awaiting_annotation' ELSE 'run_completed' END END AS event_type,
  CASE WHEN event_type = 'signup' AND event_id % 3 = 2 THEN CASE WHEN event_id % 2 = 0 THEN 'success' ELSE 'partial_failure' END END AS new_status,
  concat(CAST(user_id AS STRING),'_PKG') AS filename, ts AS event_ts
FROM events""",
    "fx_pages": r"""
SELECT concat(CAST(l_orderkey AS STRING),'_ORDER') AS filename,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_shipdate) AS INT) AS page_num,
  CAST(count(*) OVER (PARTITION BY l_orderkey) AS INT) AS total_pages,
  l_returnflag, l_linestatus, l_suppkey FROM lineitem""",
    "fx_elements": r"""
SELECT filename, page_num, 0 + (page_num - 1) * 2 AS element_id, 'title' AS element_type,
  concat('Commercial ', l_returnflag, ' Form CBP 7501') AS content FROM fx_pages WHERE l_linestatus = 'O'
UNION ALL SELECT filename, page_num, 1 + (page_num - 1) * 2, 'text',
  concat('invoice number: INV-', CAST(l_suppkey AS STRING), ' rev ', l_returnflag, ' Page ', CAST(page_num AS STRING), ' of ', CAST(total_pages AS STRING), ' end Page ', CAST(page_num AS STRING), '/', CAST(total_pages AS STRING)) FROM fx_pages""",
    "fx_doc_elements": r"""
SELECT filename, page_num, 2 * (page_num - 1) AS element_id, CASE WHEN page_num % 2 = 1 THEN 'title' ELSE 'sectionHeading' END AS element_type,
  concat('Section "', source, '" \', lang) AS content FROM fx_doc_pages WHERE page_num % 3 = 1
UNION ALL SELECT filename, page_num, 2 * (page_num - 1) + 1, 'text', concat(head, body, tail) FROM fx_doc_pages""",
    "fx_doc_pages": r"""
SELECT concat(d.doc_id, '_DOC') AS filename, d.source, d.lang, CAST(p AS INTEGER) AS page_num, CAST(n AS INTEGER) AS total_pages,
  substr(text, (p - 1) * 600 + 1, 600) AS body,
  CASE (d.doc_id * 7 + p) % 9 WHEN 0 THEN concat('Page ', p, ' of ', n, ' ') WHEN 1 THEN concat('- ', p, ' / ', n, ' - ')
    WHEN 2 THEN 'Form 3461 ' WHEN 3 THEN concat('Form CBP 7512 invoice no: INV-', d.doc_id % 50, ' ')
    WHEN 4 THEN concat('INVOICE # A/1.', p, ' ') WHEN 5 THEN concat('page ', p, '/', n, chr(10)) ELSE '' END AS head,
  CASE WHEN p % 4 = 0 THEN concat(chr(10), 'Page ', p, '/ ', n) ELSE '' END AS tail
FROM (SELECT doc_id, source, lang, coalesce(text, '') AS text, greatest(1, CAST(ceil(length(coalesce(text, '')) / 600.0) AS BIGINT)) AS n
  FROM documents) d, LATERAL (SELECT unnest(generate_series(1, d.n)) AS p) s""",
    "fx_gt_starts": r"""
SELECT filename, page_num, total_pages FROM (SELECT filename, page_num, total_pages, l_returnflag,
  lag(l_returnflag) OVER (PARTITION BY filename ORDER BY page_num) AS prev FROM fx_pages) t WHERE page_num = 1 OR l_returnflag <> prev""",
    "fx_model_starts": r"""
SELECT filename, page_num, total_pages FROM (SELECT filename, page_num, total_pages, l_linestatus,
  lag(l_linestatus) OVER (PARTITION BY filename ORDER BY page_num) AS prev FROM fx_pages) t WHERE page_num = 1 OR l_linestatus <> prev""",
    "fx_long_pages": r"""
SELECT concat(CAST(l_suppkey AS STRING),'_LONG') AS filename,
  CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey,l_linenumber,l_partkey,l_extendedprice,l_shipdate) AS INT) AS page_num,
  CAST(count(*) OVER (PARTITION BY l_suppkey) AS INT) AS total_pages, concat('block ', CAST(l_orderkey AS STRING)) AS page_block FROM lineitem""",
    "fx_responses": r"""
SELECT concat(CAST(o_orderkey AS STRING),'_ORDER') AS filename, CAST(1 + o_orderkey % 60 AS INT) AS total_pages,
  CASE o_orderkey % 8 WHEN 0 THEN '{"predicted_starts": [1, 3, 9]}' WHEN 1 THEN concat('```json', chr(10), '{"predicted_starts": [9, 3, 3]}', chr(10), '```')
    WHEN 2 THEN 'sure: {"predicted_starts": [2, "5", "99999999999", 1e20, 7.9]} done' WHEN 3 THEN '{bad' WHEN 4 THEN '{}' WHEN 5 THEN '{"predicted_starts": null}'
    WHEN 6 THEN 'no json' END AS raw_response,
  CASE WHEN o_orderkey % 8 = 7 THEN 'timeout' END AS error_message FROM orders""",
    "fx_fallback_responses": r"""
SELECT concat(CAST(o_orderkey AS STRING),'_ORDER') AS filename, CAST(1 + o_orderkey % 60 AS INT) AS total_pages,
  CASE (o_orderkey + 3) % 8 WHEN 0 THEN '{"predicted_starts": [1, 3, 9]}' WHEN 1 THEN concat('```json', chr(10), '{"predicted_starts": [9, 3, 3]}', chr(10), '```')
    WHEN 2 THEN 'sure: {"predicted_starts": [2, "5", "99999999999", 1e20, 7.9]} done' WHEN 3 THEN '{bad' WHEN 4 THEN '{}' WHEN 5 THEN '{"predicted_starts": null}'
    WHEN 6 THEN 'no json' END AS raw_response,
  CASE WHEN (o_orderkey + 3) % 8 = 7 THEN 'timeout' END AS error_message FROM orders""",
    "fx_manifest": r"""
SELECT v.volume, k.day_id, k.filename
FROM (SELECT DISTINCT day_id, filename, CAST(substr(day_id,5,2) AS INT) AS m, CAST(folder_id AS BIGINT) AS f FROM fx_log) k
CROSS JOIN (SELECT 'inbox' AS volume UNION ALL SELECT 'validation' UNION ALL SELECT 'ground_truth' UNION ALL SELECT 'archive') v
WHERE v.volume = 'inbox' OR (v.volume = 'archive' AND k.m = 12)
   OR (v.volume = 'validation' AND k.m % 3 = 0 AND k.f % 192 = 0)
   OR (v.volume = 'ground_truth' AND k.m % 3 = 0 AND k.f % 192 = 0 AND (k.m = 6 OR k.f % 128 = 0))""",
    "fx_transfer": r"""
SELECT filename, concat(filename,'_',lpad(CAST(page_num AS STRING),3,'0'),'.pdf') AS out_name,
  CAST(l_suppkey AS STRING) AS folder_id, CAST(1000 + page_num AS BIGINT) AS local_size,
  CASE WHEN (page_num + l_suppkey) % 37 = 0 THEN NULL WHEN (page_num + l_suppkey) % 29 = 0 THEN CAST(7 AS BIGINT) ELSE CAST(1000 + page_num AS BIGINT) END AS remote_size,
  l_suppkey % 11 <> 0 AS remote_folder_exists,
  CASE WHEN (page_num + l_suppkey) % 23 = 0 THEN concat('conn reset ', repeat('x', l_suppkey % 400)) END AS upload_error FROM fx_pages""",
    "fx_eval_sets": r"""
SELECT g.filename, g.total_pages, g.starts AS gt_starts, m.starts AS model_starts
FROM (SELECT filename, max(total_pages) AS total_pages, list(page_num ORDER BY page_num) AS starts FROM fx_gt_starts GROUP BY filename) g
LEFT JOIN (SELECT filename, list(page_num ORDER BY page_num) AS starts FROM fx_model_starts
           WHERE right(filename,7) <> '7_ORDER' GROUP BY filename) m ON m.filename = g.filename""",
    "fx_parsed": r"""
SELECT filename, concat('{"document":{"elements":[', string_agg(concat('{"id":',CAST(element_id AS STRING),',"type":"',element_type,'","content":"',content,
  '","bbox":[{"page_id":',CAST(page_num-1 AS STRING),'}]}'), ',' ORDER BY element_id), ']}}') AS parsed_content
FROM fx_elements GROUP BY filename""",
}

_NAME = re.compile(r"\bfx_[a-z_]+\b")


def _deps(name: str) -> list[str]:
    return [d for d in dict.fromkeys(_NAME.findall(FX_SQL[name])) if d != name]


def with_fixtures(body: str) -> str:
    """Prefix ``body`` with CTEs for every adapter it (transitively) names."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or n not in FX_SQL:
            return
        for d in _deps(n):
            visit(d)
        order.append(n)

    for n in dict.fromkeys(_NAME.findall(body)):
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({FX_SQL[n].strip()})" for n in order)
    stripped = body.lstrip()
    head = stripped[:15].upper()
    if head.startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{stripped[len('WITH RECURSIVE'):].lstrip()}"
    if head.startswith("WITH"):
        return f"WITH {ctes},\n{stripped[4:].lstrip()}"
    return f"WITH {ctes}\n{stripped}"
