"""Counts that are kept up by signed deltas instead of a new pass over all rows (WIN1, AGG1, AGG2).

An update touches some files.  Their status rows before it (weight -1) and after it (weight +1) sum up to what changes in
the counts of their batches; stored counts and delta are added up.  The work grows with the files that an update
touches and the number of batches, not with the tables.  Event marks are maxima of an append-only table, so the
greater of the stored and the new one counts.

Defined results: an update that changes nothing has an empty or all-zero delta; a batch whose last file goes
leaves the counts, one whose first file comes enters them; the order of updates does not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions.common import KEYS
from folio.operators import views as V


def status_of(log: DataFrame, split: DataFrame, files: DataFrame) -> DataFrame:
    """WIN1 for the files that ``files`` (day_id, filename, ...) names: only their rows are ranked."""
    keys = files.select(*KEYS).distinct()
    mine = lambda t: t.join(keys, list(KEYS), "left_semi")
    return V.file_status(mine(log), mine(split))


def funnel_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """What changes in the funnel where the status rows ``before`` of some files become ``after``."""
    counters = V.funnel_counters()

    def weighed(status: DataFrame, weight: int) -> DataFrame:
        return status.select("day_id", *[F.when(c, F.lit(weight)).otherwise(F.lit(0)).cast("bigint").alias(n) for n, c in counters.items()])

    return weighed(before, -1).unionByName(weighed(after, 1)).groupBy("day_id").agg(*[F.sum(n).alias(n) for n in counters])


def merged(counts: DataFrame, delta: DataFrame, alive: str = "n_files") -> DataFrame:
    """Stored counts per batch with a delta added; batches without a file (``alive`` is 0) go."""
    names = [c for c in counts.columns if c != "day_id"]
    both = counts.unionByName(delta.select(*counts.columns))
    return both.groupBy("day_id").agg(*[F.sum(n).alias(n) for n in names]).where(F.col(alive) != 0)


def marks_after(marks: DataFrame, events: DataFrame) -> DataFrame:
    """Stored event marks with newly appended events taken in."""
    return (marks.unionByName(V.event_marks(events)).groupBy("day_id")
            .agg(F.max("last_event_ts").alias("last_event_ts"), F.max("gate_opened").alias("gate_opened")))


def batch_status(counts: DataFrame, marks: DataFrame) -> DataFrame:
    """AGG2 from stored counts and marks."""
    return V.with_lifecycle(counts, marks)
