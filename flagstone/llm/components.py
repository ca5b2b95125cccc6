"""Connected components of a table of links, by least labels and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flagstone.sources.scratch import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); the component is its least node.

    Each round a node takes the least label among its neighbours' and its own, then the label of
    that label. Rounds end when no label changes; there are about log(diameter) of them. Minima
    are combined before the shuffle; each round's labels are a written table.
    """
    pairs = links.where("a <> b").select("a", "b")
    edges = staged(
        pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges",
    )
    labels = staged(
        edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
            "node", F.least("node", "m").alias("component")
        ),
        "labels",
    )
    while True:
        near = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.least("component", "near").alias("component"), F.col("component").alias("old")
        )
        lower = staged(lower, "lower")
        jump = lower.select(F.col("node").alias("component"), F.col("component").alias("further"))
        step = staged(
            lower.join(jump, "component", "left").select(
                "node", F.least("component", "further").alias("component"), "old"
            ),
            "labels",
        )
        labels = step.select("node", "component")
        if step.where("component <> old").isEmpty():
            return labels
