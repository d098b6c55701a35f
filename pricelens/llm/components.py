"""Connected components of a link table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import materialise


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (node, label): the smallest node of its component, for every node
    that has a link. Each round spreads labels along the links, then follows labels of
    labels, so the rounds grow with the logarithm of a path's length, not with it. A hub of
    many links meets only partial minima. No links give no rows."""
    edges = materialise(links.where("a != b").select("a", "b")
                        .union(links.where("a != b").select("b", "a")).distinct(), "cc-edges")
    labels = materialise(edges.groupBy(F.col("a").alias("node"))
                         .agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("label")), "cc-labels")
    while True:
        near = (edges.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        spread = labels.join(near, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        nxt = materialise(spread.join(up, "label").select(
            "node", "was", F.least("label", "up").alias("label")), "cc-labels")
        labels = nxt.select("node", "label")
        if nxt.where("was != label").isEmpty():
            return labels
