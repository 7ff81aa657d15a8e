"""Registry of checkable queries: key -> (Spark callable, oracle SQL or None)."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.plans.oracle_fixtures import with_fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def zero_count_if(sql: str) -> str:
    """Wrap every ``count_if(..)`` of an oracle query in ``CAST(coalesce(.., 0) AS BIGINT)``.

    The oracle engine's ``count_if`` is NULL when the condition is NULL on every
    row of a group; Spark's (and SUM(CASE ..)) is 0, which is what the
    operators return.
    """
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j])
        out.append(f"CAST(coalesce({key}{zero_count_if(sql[j + len(key):k])}, 0) AS BIGINT)")  # inner part keeps its ')'

        i = k


def wall_clock(df: DataFrame) -> DataFrame:
    """Return zone-aware timestamp columns as zone-less wall-clock values, the type
    of the source tables, so results do not depend on the session time zone."""
    if not any(isinstance(f.dataType, T.TimestampType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
                       else F.col(f.name) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL (if any)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return wall_clock(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = zero_count_if(with_fixtures(sql))
        return fn

    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from folio.plans import (q_boundaries, q_delivery, q_documents, q_evaluation, q_intake,  # noqa: F401
                             q_prompts, q_signals, q_views)
