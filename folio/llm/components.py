"""Connected components of an edge list, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import keep


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for all nodes of ``edges`` (a, b); the label is the least node of the component.

    Every round each node takes the least label among its neighbours and then its label's label.  Then the edges
    are contracted: their ends become labels, loops and repeats go.  So the edge table shrinks from round to
    round, and only nodes that are still ends of edges take part; the others follow their label at the end.
    Rounds are written to the shared checkpoint folder; the driver sees one count per round.
    """
    pair = lambda a, b: [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]
    left = keep(edges.where(F.col("a") != F.col("b")).select(*pair("a", "b")).distinct(), "edges")
    steps = []
    while not steps or left.limit(1).count():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("up")), "labels")
        above = least.select(F.col("node").alias("up"), F.col("up").alias("label"))
        step = keep(least.join(above, "up").select("node", "label"), "labels")
        steps.append(step)
        a, b = (step.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label")) for c in "ab")
        left = keep(left.join(a, "a").join(b, "b").where("a_label != b_label").select(*pair("a_label", "b_label")).distinct(), "edges")
    # a node's label in one round is a node of the next round, or has no edge any more
    labels = steps.pop()
    while steps:
        after = labels.select(F.col("node").alias("label"), F.col("label").alias("final"))
        labels = keep(steps.pop().join(after, "label", "left").select("node", F.coalesce("final", "label").alias("label")), "labels")
    return labels
