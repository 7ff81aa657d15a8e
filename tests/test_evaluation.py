"""Boundary metrics: the reference's example cases, plus a brute-force check of the
greedy tolerant matching."""

import random

import pytest
from pyspark.sql import functions as F

from folio.operators import evaluation as EV


def metrics(spark, rows):
    df = spark.createDataFrame([(str(i), g, m) for i, (g, m) in enumerate(rows)],
                               "filename string, gt_starts array<int>, model_starts array<int>")
    return {r["filename"]: r.asDict() for r in EV.boundary_metrics(df).collect()}


def one(spark, gt, model):
    return metrics(spark, [(gt, model)])["0"]


def test_exact_match(spark):
    r = one(spark, [1, 5, 9], [1, 5, 9])
    assert r["exact_match"] and r["precision"] == r["recall"] == r["f1"] == 1.0 and r["multidoc_correct"]


def test_off_by_one(spark):
    r = one(spark, [1, 5, 9], [1, 6, 9])
    assert not r["exact_match"] and r["n_offby1"] == 1 and r["f1"] == 0.5 and r["f1_tol"] == 1.0


def test_false_positive(spark):
    r = one(spark, [1, 5], [1, 5, 7])
    assert r["n_false_positive"] == 1 and r["precision"] == 0.5 and r["recall"] == 1.0


def test_false_negative(spark):
    r = one(spark, [1, 4, 8], [1, 8])
    assert r["n_false_negative"] == 1 and r["recall"] == 0.5 and r["multidoc_correct"]


def test_single_document(spark):
    r = one(spark, [1], [1])
    assert r["exact_match"] and not r["gt_is_multidoc"] and r["multidoc_correct"]


def test_multidoc_misclassified(spark):
    r = one(spark, [1, 6], [1])
    assert not r["multidoc_correct"] and r["n_false_negative"] == 1


def test_unsorted_with_duplicates(spark):
    assert one(spark, [9, 1, 5, 5], [1, 9, 5])["exact_match"]


def test_greedy_is_not_optimal(spark):
    r = one(spark, [1, 5, 6], [1, 4, 5])
    assert r["tp_tol"] == 1 and r["n_offby1"] == 0
    r = one(spark, [1, 5], [1, 4, 6])
    assert r["tp_tol"] == 1 and r["n_offby1"] == 1


def test_no_model_gives_null_metrics(spark):
    df = spark.createDataFrame([("a", [1, 3], None)], "filename string, gt_starts array<int>, model_starts array<int>")
    r = EV.boundary_metrics(df).first()
    assert r["exact_match"] is None and r["f1"] is None


def greedy(gt, pred):
    """Nearest-first greedy scan over the sorted predictions (brute force)."""
    gt = [p for p in sorted(set(gt)) if p != 1]
    pred = [p for p in sorted(set(pred)) if p != 1]
    used = [False] * len(pred)
    m = o = 0
    for g in gt:
        best, bd = -1, 2
        for j, p in enumerate(pred):
            if used[j]:
                continue
            d = abs(g - p)
            if d < bd:
                best, bd = j, d
                if d == 0:
                    break
        if best >= 0:
            used[best] = True
            m += 1
            o += bd == 1
    return m, o


def test_tolerant_fold_equals_greedy_scan(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(3000):
        n = rnd.randint(1, 40)
        rows.append(([1] + rnd.sample(range(2, n + 2), rnd.randint(0, min(n, 8))),
                     [1] + rnd.sample(range(2, n + 2), rnd.randint(0, min(n, 8)))))
    got = metrics(spark, rows)
    for i, (g, m) in enumerate(rows):
        r = got[str(i)]
        assert (r["tp_tol"], r["n_offby1"]) == greedy(g, m), (g, m)


@pytest.mark.parametrize("k,n", [(1, 32), (1, 160), (3, 8), (2, 3), (0, 0), (5, 5)])
def test_ratio_rounding_half_even_on_exact_value(spark, k, n):
    from fractions import Fraction
    from folio.functions.metrics import ratio4
    got = spark.range(1).select(ratio4(F.lit(k), F.lit(n)).alias("r")).first()["r"]
    if n == 0:
        assert got == 0.0
    else:
        assert got == float(round(Fraction(k, n), 4))


def test_eval_stats_empty_is_zero(spark):
    df = spark.createDataFrame([], "filename string, gt_starts array<int>, model_starts array<int>")
    ev = EV.evaluate(df.select("filename", F.lit(3).alias("total_pages"), "gt_starts"),
                     df.select("filename", "model_starts"))
    r = EV.eval_stats(ev).first()
    assert r["n_annotated"] == 0 and r["exact_rate"] == 0.0 and r["avg_f1"] == 0.0


def test_fold_on_large_and_small_sets_equals_greedy_scan(spark):
    """One fold for every size, against the brute-force scan (the last sets exceed 4,096 pairs)."""
    from folio.functions.metrics import tolerant_fold
    rnd = random.Random(3)
    rows = []
    for _ in range(1500):
        n = rnd.randint(1, 60)
        g = sorted(rnd.sample(range(2, n + 3), rnd.randint(0, min(n, 20))))
        p = sorted(rnd.sample(range(2, n + 3), rnd.randint(0, min(n, 20))))
        rows.append((g, p))
    for n in (150, 400):
        rows.append((sorted(rnd.sample(range(2, n), 90)), sorted(rnd.sample(range(2, n), 90))))
    df = spark.createDataFrame([(i, g, p) for i, (g, p) in enumerate(rows)], "i int, g array<int>, p array<int>")
    got = df.select("i", tolerant_fold(F.col("g"), F.col("p")).alias("a"))
    for r in got.collect():
        want = greedy([1] + rows[r["i"]][0], [1] + rows[r["i"]][1])
        assert (r["a"]["m"], r["a"]["o"]) == want


def test_evaluation_rows_take_the_latest_prediction_in_table_layout(spark):
    from folio.schemas import EVALUATION_RESULTS
    gt = spark.createDataFrame([("d1", "a", "f1", 9, [1, 5], True, "ann"), ("d2", "a", "f2", 4, [1], False, "bob")],
                               "day_id string, filename string, folder_id string, total_pages int, predicted_starts array<int>, "
                               "is_multidoc boolean, annotator string")
    split = spark.createDataFrame([("d1", "a", [1, 3], "old", "2024-01-01 00:00:00"), ("d1", "a", [1, 5], "new", "2024-01-02 00:00:00")],
                                  "day_id string, filename string, predicted_starts array<int>, model_used string, processing_timestamp string")
    rows = EV.evaluation_rows(gt, split, F.lit("2024-02-01 00:00:00").cast("timestamp"))
    assert rows.columns == EVALUATION_RESULTS.names
    got = {r["day_id"]: r for r in rows.collect()}
    assert got["d1"]["model_used"] == "new" and got["d1"]["exact_match"] and got["d1"]["annotator"] == "ann" and got["d1"]["folder_id"] == "f1"
    assert got["d2"]["model_starts"] is None and got["d2"]["exact_match"] is None and got["d2"]["gt_n_documents"] == 1
