"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteledger.operators import staged


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each of ``nodes`` (node) reaches over ``links`` (a, b).

    Each round takes the smallest label next to a node and then the label of
    that label, so the rounds grow with the logarithm of a component's width.
    Labels are combined before they are shuffled and staged each round.
    """
    both = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = staged(nodes.select("node", F.col("node").alias("label")))
    while True:
        near = both.join(labels, both["a"] == labels["node"]).groupBy("b").agg(F.min("label").alias("near"))
        closer = staged(labels.join(near, labels["node"] == near["b"], "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("next")))
        jump = closer.select(F.col("node").alias("_n"), F.col("next").alias("_l"))
        moved = staged(closer.join(jump, closer["next"] == jump["_n"]).select("node", F.col("_l").alias("label"), (F.col("_l") != F.col("label")).alias("moved")))
        labels = moved.select("node", "label")
        if moved.where("moved").isEmpty():
            return labels
