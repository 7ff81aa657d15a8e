"""Boundary-set metrics as native column expressions (no UDFs).

A boundary set is an ARRAY<INT> of 1-based first pages.  Page 1 is excluded
from precision / recall / F1 but included in ``exact_match``.

Rounding: the reference rounds ratios to 4 decimals with Python's
round-half-even.  Ratios here are ratios of integers, so they are rounded with
exact integer arithmetic (half-even on the exact rational value), which any
engine reproduces bit for bit.  Averages over stored 4-decimal metrics are
taken on their integer numerators for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize(arr: Column) -> Column:
    """int, distinct, ascending."""
    return F.array_sort(F.array_distinct(arr))


def ratio4_units(num: Column, den: Column) -> Column:
    """round_half_even(num / den, 4) * 10000 as BIGINT; 0 when den is 0."""
    n10 = num.cast("bigint") * F.lit(10000)
    d0 = den.cast("bigint")
    d = F.when(d0 == 0, F.lit(1).cast("bigint")).otherwise(d0)  # never divide by zero under ANSI
    rem = n10 % d
    q = ((n10 - rem) / d).cast("bigint")  # exact: n10 - rem is a multiple of d
    up = (rem * 2 > d) | ((rem * 2 == d) & (q % 2 == 1))
    return F.when(d0 == 0, F.lit(0).cast("bigint")).otherwise(q + up.cast("bigint"))


def ratio4(num: Column, den: Column) -> Column:
    return ratio4_units(num, den) / F.lit(10000.0)


def units4(x: Column) -> Column:
    """Back from a stored 4-decimal double to its integer numerator."""
    return F.round(x * 10000).cast("bigint")


def tolerant_fold(gt: Column, pred: Column) -> Column:
    """Greedy one-to-one matching within one page, ground truth ascending.

    For each ground-truth page g (ascending) the first unused predicted page
    among g, g-1, g+1 is taken, which is what a nearest-first scan of the
    sorted predictions picks (ties go to the lower page).  Returns
    ``struct(m, o)``: matches and off-by-one matches.

    Linear after one sort: the pages a greedy pass takes are strictly
    increasing, so "unused" is just "above the last page taken" (``last``).
    Both lists are merged in ascending order (a prediction before a
    ground-truth page of the same number) and folded once.  A ground-truth
    page that finds neither g nor g-1 waits (``wait``) for the next element:
    it takes g+1 only if that is the very next prediction.
    """
    ev = F.array_sort(F.concat(F.transform(pred, lambda p: F.struct(p.alias("v"), F.lit(0).alias("t"))),
                               F.transform(gt, lambda g: F.struct(g.alias("v"), F.lit(1).alias("t")))))
    none = F.lit(None).cast("int")
    init = F.struct(none.alias("last"), none.alias("p1"), none.alias("p2"), none.alias("wait"),
                    F.lit(0).alias("m"), F.lit(0).alias("o"))

    def step(s: Column, e: Column) -> Column:
        v, is_gt = e["v"], e["t"] == 1
        last, p1, p2, wait = s["last"], s["p1"], s["p2"], s["wait"]
        free = lambda x: x.isNotNull() & (last.isNull() | (x > last))
        # a waiting page g takes g+1 when g+1 is the next prediction
        take_next = ~is_gt & wait.isNotNull() & (v == wait + 1) & free(v)
        last1 = F.when(take_next, v).otherwise(last)
        m1 = s["m"] + F.when(take_next, 1).otherwise(0)
        o1 = s["o"] + F.when(take_next, 1).otherwise(0)
        # predictions seen so far: the two largest (p1 >= p2)
        np1 = F.when(is_gt, p1).otherwise(v)
        np2 = F.when(is_gt, p2).otherwise(p1)
        free1 = lambda x: x.isNotNull() & (last1.isNull() | (x > last1))
        hit_g = is_gt & (np1 == v) & free1(np1)
        prev = F.when(np1 == v, np2).otherwise(np1)  # largest prediction below g
        hit_gm1 = is_gt & ~hit_g & (prev == v - 1) & free1(prev)
        got = F.when(hit_g, v).when(hit_gm1, v - 1)
        return F.struct(
            F.coalesce(got, last1).alias("last"), np1.alias("p1"), np2.alias("p2"),
            F.when(is_gt & got.isNull(), v).when(is_gt, none).when(take_next, none)
             .when(wait.isNotNull() & (v > wait + 1), none).otherwise(wait).alias("wait"),
            (m1 + F.when(got.isNotNull(), 1).otherwise(0)).alias("m"),
            (o1 + F.when(hit_gm1, 1).otherwise(0)).alias("o"))

    r = F.aggregate(ev, init, step)
    return F.struct(r["m"].alias("m"), r["o"].alias("o"))


def with_metrics(df: DataFrame, gt: str, model: str) -> DataFrame:
    """Append all per-package metrics of one ground-truth / model pair.

    Two projections: the sets and the tolerant fold are computed once in the
    first, the ratios read them in the second (Catalyst keeps the fold from
    being inlined into every metric that uses it).  Every metric is NULL where
    the model set is NULL.
    """
    gfull, pfull = normalize(F.col(gt)), normalize(F.col(model))
    base = df.select("*", gfull.alias("_gfull"), pfull.alias("_pfull"))
    g, p = F.array_remove(F.col("_gfull"), 1), F.array_remove(F.col("_pfull"), 1)
    sets = base.select("*", g.alias("_g"), p.alias("_p"))
    g, p = F.col("_g"), F.col("_p")
    counted = sets.select(
        "*",
        F.size(F.array_intersect(g, p)).alias("_tp"),
        F.size(F.array_except(p, g)).alias("_fp"),
        F.size(F.array_except(g, p)).alias("_fn"),
        tolerant_fold(g, p).alias("_fold"),
    )
    tp, fp, fn = F.col("_tp"), F.col("_fp"), F.col("_fn")
    tpt, ng, npred = F.col("_fold.m"), F.size("_g"), F.size("_p")
    gm, pm = F.size("_gfull") > 1, F.size("_pfull") > 1
    has = F.col(model).isNotNull()
    out = [
        ("exact_match", F.col("_gfull") == F.col("_pfull")),
        ("n_true_positive", tp), ("n_false_positive", fp), ("n_false_negative", fn),
        ("precision", ratio4(tp, tp + fp)),
        ("recall", ratio4(tp, tp + fn)),
        # 2PR/(P+R) of the unrounded ratios equals 2tp/(2tp+fp+fn).
        ("f1", ratio4(2 * tp, 2 * tp + fp + fn)),
        ("n_offby1", F.col("_fold.o")),
        ("tp_tol", tpt),
        ("precision_tol", ratio4(tpt, npred)),
        ("recall_tol", ratio4(tpt, ng)),
        ("f1_tol", ratio4(2 * tpt, npred + ng)),
        ("gt_is_multidoc", gm),
        ("model_is_multidoc", pm),
        ("multidoc_correct", gm == pm),
    ]
    keep = [c for c in df.columns if c not in {n for n, _ in out}]
    return counted.select(*keep, *[F.when(has, e).alias(n) for n, e in out])


def to_documents(starts: Column, total_pages: Column) -> Column:
    """Starts -> ARRAY<STRUCT<start, end>>: end is the next start - 1, or the last page."""
    return F.transform(starts, lambda s, i: F.struct(
        s.alias("start"),
        F.coalesce(F.get(starts, i + 1) - 1, total_pages).alias("end")))


def canonical_starts(starts: Column, total_pages: Column) -> Column:
    """Clip to 1..total_pages, always contain page 1, ascending distinct."""
    inside = F.filter(starts, lambda x: (x >= 1) & (x <= total_pages))
    return F.array_sort(F.array_union(F.array(F.lit(1)), inside))


def parse_int_array(s: Column) -> Column:
    """'[1, 5]' or '["1","5"]' (as text) -> ARRAY<INT>; NULL/blank -> empty."""
    body = F.regexp_replace(F.trim(s), r"^\[|\]$", "")
    parts = F.filter(F.split(body, ","), lambda x: F.trim(x) != "")
    arr = F.transform(parts, lambda x: F.regexp_replace(F.trim(x), "^[\"']|[\"']$", "").cast("int"))
    return F.when(s.isNull() | (F.trim(s) == ""), F.array().cast("array<int>")).otherwise(arr)
