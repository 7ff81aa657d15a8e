"""Reusable SQL fragments for the oracle queries (written for the oracle dialect)."""

from __future__ import annotations


def r4_units(num: str, den: str) -> str:
    """round_half_even(num/den, 4) * 10000 with integer arithmetic, 0 when den = 0."""
    n10 = f"(CAST({num} AS BIGINT) * 10000)"
    d = f"CAST({den} AS BIGINT)"
    q = f"({n10} // {d})"
    rem = f"({n10} % {d})"
    return (f"(CASE WHEN {d} = 0 THEN 0 ELSE {q} + CASE WHEN 2 * {rem} > {d} OR (2 * {rem} = {d} AND {q} % 2 = 1) "
            f"THEN 1 ELSE 0 END END)")


def r4(num: str, den: str) -> str:
    return f"({r4_units(num, den)} / 10000.0)"


def units4(x: str) -> str:
    return f"CAST(round({x} * 10000) AS BIGINT)"


def atext(x: str) -> str:
    """Integer list as comma-joined text."""
    return f"array_to_string({x}, ',')"


def norm(x: str) -> str:
    return f"list_sort(list_distinct({x}))"


# Per-package metrics over a relation `src(filename, total_pages, gt_starts, model_starts)`;
# produces CTEs `mb` (base sets), `tol` (greedy tolerant matches), `met` (all metrics).
# Needs the query to start with WITH RECURSIVE.
def metric_ctes(src: str) -> str:
    return f"""
mb AS (SELECT *, {norm('gt_starts')} AS gfull, {norm('model_starts')} AS pfull,
    list_filter({norm('gt_starts')}, lambda x: x <> 1) AS g, list_filter({norm('model_starts')}, lambda x: x <> 1) AS p
  FROM {src}),
w AS (
  SELECT filename, g AS gt, p AS u, 1 AS i, 0 AS m, 0 AS o FROM mb WHERE model_starts IS NOT NULL
  UNION ALL
  SELECT filename, gt, CASE WHEN hit IS NULL THEN u ELSE list_filter(u, lambda x: x <> hit) END, i + 1,
         m + CASE WHEN hit IS NULL THEN 0 ELSE 1 END,
         o + CASE WHEN hit IS NULL OR hit = gt[i] THEN 0 ELSE 1 END
  FROM (SELECT *, CASE WHEN list_contains(u, gt[i]) THEN gt[i] WHEN list_contains(u, gt[i] - 1) THEN gt[i] - 1
                       WHEN list_contains(u, gt[i] + 1) THEN gt[i] + 1 END AS hit FROM w WHERE i <= len(gt)) z),
tol AS (SELECT filename, m AS tp_tol, o AS n_offby1 FROM w WHERE i = len(gt) + 1),
cnt AS (SELECT mb.*, tol.tp_tol, tol.n_offby1,
    CAST(len(list_filter(p, lambda x: list_contains(g, x))) AS INTEGER) AS tp,
    CAST(len(list_filter(p, lambda x: NOT list_contains(g, x))) AS INTEGER) AS fp,
    CAST(len(list_filter(g, lambda x: NOT list_contains(p, x))) AS INTEGER) AS fn
  FROM mb LEFT JOIN tol ON tol.filename = mb.filename),
met AS (SELECT *,
    CASE WHEN model_starts IS NOT NULL THEN gfull = pfull END AS exact_match,
    CASE WHEN model_starts IS NOT NULL THEN tp END AS n_true_positive,
    CASE WHEN model_starts IS NOT NULL THEN fp END AS n_false_positive,
    CASE WHEN model_starts IS NOT NULL THEN fn END AS n_false_negative,
    CASE WHEN model_starts IS NOT NULL THEN {r4('tp', 'tp + fp')} END AS precision,
    CASE WHEN model_starts IS NOT NULL THEN {r4('tp', 'tp + fn')} END AS recall,
    CASE WHEN model_starts IS NOT NULL THEN {r4('2 * tp', '2 * tp + fp + fn')} END AS f1,
    CASE WHEN model_starts IS NOT NULL THEN {r4('tp_tol', 'len(p)')} END AS precision_tol,
    CASE WHEN model_starts IS NOT NULL THEN {r4('tp_tol', 'len(g)')} END AS recall_tol,
    CASE WHEN model_starts IS NOT NULL THEN {r4('2 * tp_tol', 'len(p) + len(g)')} END AS f1_tol,
    CASE WHEN model_starts IS NOT NULL THEN len(gfull) > 1 END AS gt_is_multidoc_m,
    CASE WHEN model_starts IS NOT NULL THEN len(pfull) > 1 END AS model_is_multidoc,
    CASE WHEN model_starts IS NOT NULL THEN (len(gfull) > 1) = (len(pfull) > 1) END AS multidoc_correct
  FROM cnt)"""
