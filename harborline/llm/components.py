"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """Per node of the links (a, b): node and label, the smallest node of its component.

    Each round takes the smallest label among a node's neighbours and then the label of that label, so the rounds grow
    with the logarithm of a component's width; each is one written table, with plain joins that Spark may split.
    """
    edges = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy(F.col("a").alias("_a")).agg(F.min("label").alias("near"))
        low = labels.join(near, labels["node"] == F.col("_a")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("_n"), F.col("label").alias("next"))
        low = low.join(jump, low["low"] == jump["_n"], "left").select(
            "node", F.least("low", F.coalesce("next", "low")).alias("label"), "old")
        low = written(low, "labels")
        changed = low.where(F.col("label") != F.col("old")).limit(1).count()
        labels = low.select("node", "label")
        if not changed:
            return labels
