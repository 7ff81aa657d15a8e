"""Model-response parsing as native expressions (PRM7, BND9): no Python UDF.

Both parsers turn free text into a boundary set and must never fail a task:
anything unparseable becomes data (NULL, or the unchanged proposal).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The response clean-up and extraction patterns.
FENCE_RE = r"```(?:json)?\s*"
FIRST_OBJECT_RE = r"(?s)\{.*?\}"   # non-greedy: a nested object is cut at the inner brace
ARRAY_RE = r"(?s)\[.*\]"           # greedy: first '[' to last ']'
BEYOND = -1

# First three letters of the numeric variant type names (BIGINT, INT, SMALLINT, TINYINT,
# DECIMAL, DOUBLE, FLOAT).
_NUMERIC3 = ("BIG", "INT", "SMA", "TIN", "DEC", "DOU", "FLO")


def strip_fences(raw: Column) -> Column:
    return F.trim(F.regexp_replace(raw, FENCE_RE, ""))


def _typed(e: Column) -> Column:
    """Pair a JSON value with its type name, so the type is computed once."""
    return F.struct(F.substring(F.schema_of_variant(e), 1, 3).alias("k"), e.alias("e"))


def _typed_to_int(t: Column) -> Column:
    """One typed JSON value -> BIGINT the way int() coerces it; NULL where int() would fail.

    A number beyond 18 digits is in no package: it becomes ``BEYOND``, which every page range drops.
    """
    k, e = t["k"], t["e"]
    num = F.try_variant_get(e, "$", "double")
    as_num = F.when(F.abs(num) < F.lit(1.0e18), num.cast("bigint")).otherwise(F.lit(BEYOND))
    txt = F.trim(F.try_variant_get(e, "$", "string"))
    as_str = F.when(txt.rlike(r"^[+-]?0*[0-9]{1,18}$"), txt.try_cast("bigint")).when(txt.rlike(r"^[+-]?[0-9]+$"), F.lit(BEYOND))
    as_bool = F.try_variant_get(e, "$", "boolean").cast("bigint")
    return (F.when(k.isin(*_NUMERIC3), as_num).when(k == "STR", as_str).when(k == "BOO", as_bool)
            .otherwise(F.lit(None).cast("bigint")))


def with_parsed_starts(df: DataFrame, raw: str = "raw_response", total: str = "total_pages",
                       out: str = "parsed_starts") -> DataFrame:
    """``parse_starts`` as staged projections: the JSON value, the list and its
    integers are each computed once and then read by every branch (the single
    expression form recomputes them per branch)."""
    obj = F.regexp_extract(strip_fences(F.col(raw)), FIRST_OBJECT_RE, 0)
    s1 = df.withColumn("_v", F.try_parse_json(F.when(obj != "", obj)))
    s2 = s1.withColumn("_ps", F.variant_get(F.col("_v"), "$.predicted_starts", "variant"))
    s2 = s2.withColumn("_kind", F.schema_of_variant(F.col("_ps")))
    # All-integer lists (the usual answer) are read in one vectorised step; only
    # mixed lists take the per-element path, where any unreadable element fails
    # the whole answer.
    fast = F.try_variant_get(F.col("_ps"), "$", "array<bigint>")
    slow = F.transform(F.transform(F.try_variant_get(F.col("_ps"), "$", "array<variant>"), _typed), _typed_to_int)
    slow = F.when(~F.exists(slow, lambda x: x.isNull()), slow)
    s3 = s2.withColumn("_ints", F.when(F.col("_kind") == "ARRAY<BIGINT>", fast)
                       .when(F.col("_kind").startswith("ARRAY"), slow)).drop("_kind")
    ints = F.col("_ints")
    inside = F.filter(ints, lambda x: (x >= 1) & (x <= F.col(total))).cast("array<int>")
    res = (F.when(F.col("_v").isNull(), F.lit(None).cast("array<int>"))
           .when(F.col("_ps").isNull(), F.array(F.lit(1)))
           .when(ints.isNull(), F.lit(None).cast("array<int>"))
           .otherwise(F.array_sort(F.array_union(F.array(F.lit(1)), inside))))
    return s3.withColumn(out, res).drop("_v", "_ps", "_ints")


def apply_corrections(proposed: Column, response: Column, total_pages: Column) -> Column:
    """BND9: apply verification corrections in order.

    ``move``: drop ``from_page`` (never 1) if present and add ``to_page`` when it
    lies in 1..total_pages (even if ``from_page`` was absent); ``remove``: drop
    ``from_page`` (never 1); anything else is a no-op.  No response, no ``[..]``
    or unparseable JSON leaves the proposal (plus page 1) unchanged; a malformed
    item is a no-op.
    """
    start = F.array_sort(F.array_union(F.array(F.lit(1)), F.coalesce(proposed, F.array().cast("array<int>"))))
    arr_txt = F.regexp_extract(strip_fences(response), ARRAY_RE, 0)
    listed = F.try_parse_json(F.when(response.isNotNull() & (arr_txt != ""), arr_txt))
    items = F.transform(F.try_variant_get(listed, "$", "array<variant>"), lambda e: F.struct(
        F.lower(F.try_variant_get(e, "$.action", "string")).alias("action"),
        _page(F.try_variant_get(e, "$.from_page", "variant")).alias("from_page"),
        _page(F.try_variant_get(e, "$.to_page", "variant")).alias("to_page")))

    def step(acc: Column, c: Column) -> Column:
        action, frm, to = c["action"], c["from_page"], c["to_page"]
        can_drop = frm.isNotNull() & (frm != 1)
        dropped = F.when(can_drop, F.filter(acc, lambda x: x != frm)).otherwise(acc)
        can_add = to.isNotNull() & (to >= 1) & (to <= total_pages)
        moved = F.when(can_add, F.array_union(dropped, F.array(to.cast("int")))).otherwise(dropped)
        return F.when(action == "move", moved).when(action == "remove", dropped).otherwise(acc)

    none = F.array().cast("array<struct<action:string,from_page:bigint,to_page:bigint>>")
    return F.array_sort(F.aggregate(F.coalesce(items, none), start, step))


def _page(v: Column) -> Column:
    """A correction's page: a whole number, also one written as 3.0; anything else is none."""
    num = F.try_variant_get(v, "$", "double")
    kind = F.substring(F.schema_of_variant(v), 1, 3)
    return F.when(kind.isin(*_NUMERIC3) & (num == F.floor(num)) & (F.abs(num) < F.lit(1.0e9)), num.cast("bigint"))
