"""Shuffles of the page queries: rows are dealt by package once, blocks stay where they are."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from folio.operators import boundaries as BD
from folio.operators import prompts as PR
from folio.plans import registry

registry.load_all()


def shuffles(df):
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return sum("Exchange " in x and "Reused" not in x and "Broadcast" not in x for x in lines)


@pytest.mark.parametrize("name,most", [("package_summary", 1), ("prompt_plan", 1), ("rule_boundaries", 1),
                                       ("verify_windows", 2), ("verify_batch", 2), ("streamed_prompts", 4)])
def test_pages_are_dealt_by_package_once(spark, sf_small, name, most):
    """One shuffle per read of the pages (equal ones are written once), none of texts."""
    assert shuffles(registry.QUERIES[name](spark, sf_small)) <= most


def test_page_tasks_are_not_coalesced(spark, sf_small):
    plan = registry.QUERIES["package_summary"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_long_packages_are_counted_not_ordered(spark, sf_small):
    plan = registry.QUERIES["combine"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_windows_of_odd_rows(spark):
    """Repeated pages and boundaries, gaps, null keys, and a boundary far from any page."""
    pages = [("a", 1, "a1"), ("a", 2, "a2"), ("a", 2, "a2b"), ("a", 4, None), ("a", 5, "a5"), (None, 3, "n3"), ("b", None, "bx")]
    asked = [("a", 3, 9), ("a", 3, 9), ("a", 3, 8), ("a", 40, 9), (None, 3, 1), ("b", 2, 4)]
    signals = spark.createDataFrame(pages, "filename string, page_num bigint, page_block string")
    bnd = spark.createDataFrame(asked, "filename string, proposed_boundary int, total_pages int")
    got = BD.verify_windows(bnd, signals)
    assert dict(got.dtypes)["proposed_boundary"] == "int"
    want = set()
    for name, b, total in asked:
        text = f"\n=== PROPOSED BOUNDARY AT PAGE {b} ===\n"
        for off, label in ((-2, "B-2"), (-1, "B-1"), (0, "B"), (1, "B+1"), (2, "B+2")):
            at = [t for f, p, t in pages if name is not None and f == name and p == b + off and t is not None]
            if at:
                text += ("" if off == -2 else "\n") + f"PAGE {b + off} ({label}):\n" + max(at)
        want.add((name, b, total, text))
    rows = [tuple(r) for r in got.select("filename", "proposed_boundary", "total_pages", "window_context").collect()]
    assert len(rows) == len(want) and set(rows) == want


def test_streamed_pieces_are_in_order_and_not_dealt_again(spark):
    blocks = (spark.range(300).select((F.col("id") % 7).cast("string").alias("filename"), (300 - F.col("id")).alias("position"),
                                      F.col("id").cast("string").alias("text")).repartition(5, "filename"))
    out = PR.invoke_stream(blocks, lambda pieces, budget: "".join(pieces), ["filename"], sep=",")
    assert shuffles(out) == 1
    got = {r.filename: r.llm_result.result for r in out.collect()}
    assert got == {str(k): ",".join(str(i) for i in reversed(range(300)) if i % 7 == k) for k in range(7)}


def test_delivery_files_are_not_shuffled_by_folder(spark, sf_small):
    """What is routed and checked is written; what follows it is one shuffle, for the outcome of each file."""
    assert shuffles(registry.QUERIES["file_outcome"](spark, sf_small)) == 1


def test_evaluation_orders_the_pages_once(spark, sf_small):
    plan = registry.QUERIES["evaluate"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan  # both sides read the written sets
