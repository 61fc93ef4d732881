"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chattermark.sources.staging import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) of `links` (a, b): the smallest node that can be reached.

    Each round takes the smallest label among a node and its neighbours, then the
    label of that label, so the distance covered about doubles. Labels are staged
    after each round, which cuts the lineage; the driver sees a count.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stage(both.distinct(), "links")
    labels = stage(
        edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")),
        "labels",
    )
    while True:
        around = (
            edges.join(labels, edges["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        nearer = labels.join(around, labels["node"] == around["a"]).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("label")
        )
        of_label = labels.select(F.col("node").alias("label"), F.col("component").alias("next"))
        jumped = stage(
            nearer.join(of_label, "label").select("node", "old", F.col("next").alias("component")),
            "labels",
        )
        labels = jumped.select("node", "component")
        if not jumped.where("old <> component").limit(1).count():
            return labels
