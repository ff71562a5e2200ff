"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel.llm.common import materialise


def components(links: DataFrame) -> DataFrame:
    """``a, b`` -> ``node, root``: the smallest node that each node of a link
    reaches. Every round takes the smallest label among the neighbours and then
    the label of that label, so long chains shrink by halves."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialise(both, "component-links")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "component-labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("least"))
        )
        pulled = labels.join(near, "node").select("node", F.least("root", "least").alias("to"), F.col("root").alias("old"))
        of_label = labels.select(F.col("node").alias("to"), F.col("root").alias("further"))
        step = materialise(
            pulled.join(of_label, "to").select("node", F.least("to", "further").alias("root"), "old"), "component-labels"
        )
        labels = step.select("node", "root")
        if step.where(F.col("root") != F.col("old")).isEmpty():
            return labels
