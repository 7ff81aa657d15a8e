"""Small column helpers shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("day_id", "filename")


def pkg_keys(*frames: DataFrame) -> list[str]:
    """The package key that all frames carry: (day_id, filename), or filename within one batch."""
    return [c for c in KEYS if c == "filename" or all(c in f.columns for f in frames)]


def count_if(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as BIGINT (0 on an empty group)."""
    return F.coalesce(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("bigint")


def weighted_if(cond: Column, weight: Column) -> Column:
    return F.sum(F.when(cond, weight).otherwise(F.lit(0))).cast("bigint")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under ``order``.

    Written as ``row_number() = 1`` so Catalyst plans a window group limit: each
    map task keeps its own top row per key before the shuffle, so a key holding
    a large share of the rows still sends one row per task downstream.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def array_text(arr: Column, sep: str = ",") -> Column:
    """Sorted integer array as text, e.g. ``[1,5,9]`` -> ``'1,5,9'`` (stable to hash)."""
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), sep)


def valid_name(c: Column) -> Column:
    """Id safety predicate: only ``[A-Za-z0-9._-]``, non-empty, no ``..``."""
    return c.rlike(r"^[A-Za-z0-9._-]+$") & ~c.contains("..")


def to_int(c: Column) -> Column:
    """String -> INT; blank or unparseable -> NULL (the app's re-typing of warehouse text)."""
    t = F.trim(c.cast("string"))
    return F.when(t != "", t.try_cast("int"))


def to_float(c: Column) -> Column:
    """String -> DOUBLE; blank or unparseable -> NULL."""
    t = F.trim(c.cast("string"))
    return F.when(t != "", t.try_cast("double"))


def to_bool(c: Column) -> Column:
    """'true' (any case, padded) -> true, any other text -> false, NULL -> NULL."""
    return F.when(c.isNotNull(), F.lower(F.trim(c.cast("string"))) == "true")
