"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (long ``a``, ``b``); label is
    the smallest node that can be reached.

    Each round a node takes the smallest label among its neighbours and then
    the label of its label, so the distance to the smallest node halves; rounds
    grow with the logarithm of the longest path. Labels are written after each
    round to the shared folder. A node with very many neighbours is a partial
    aggregate, never a list.
    """
    both = saved(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc_edges")
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "cc_labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        low = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        new = saved(low.join(jump, "low", "left").select("node", "old", F.least("low", F.coalesce("far", "low")).alias("label")), "cc_labels")
        labels = new.select("node", "label")
        if not new.where("label <> old").limit(1).count():
            return labels
