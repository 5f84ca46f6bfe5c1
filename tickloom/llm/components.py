"""Connected components of an edge table, without leaving DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, label): each node of edges (a, b) with the smallest node of its component.

    Every round takes the smallest label among the neighbours and then the label of that label, so the number
    of rounds grows with the logarithm of a component's diameter. Each round is written to the shared folder.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct().toDF("node", "other"))
    labels = materialize(both.groupBy("node").agg(F.min("other").alias("label")).select("node", F.least("node", "label").alias("label")))
    while True:
        seen = labels.select(F.col("node").alias("other"), F.col("label").alias("seen"))
        near = both.join(seen, "other").groupBy("node").agg(F.min("seen").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = materialize(step.join(jump, "label").select("node", "was", F.least("label", "further").alias("label")))
        changed = step.where("label <> was").limit(1).count()
        labels = step.select("node", "label")
        if not changed:
            return labels
