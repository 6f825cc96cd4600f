"""Connected components by joins: every node ends with the smallest node it is linked with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayglass.llm.common import stored

ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, label) of the nodes in ``links`` (a, b).

    Each round takes the smallest label among a node's neighbours, and then the label's own label, so that chains
    shorten by half. A hot node has one row per link, never a collected list; sums are taken before the shuffle.
    Rounds are written to the shared folder, which cuts the lineage.
    """
    edges = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    edges = stored(edges, "components-edges")
    label = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "components-0")
    for number in range(1, ROUNDS):
        near = edges.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = label.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = label.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = step.join(jump, "label", "left").select("node", "old", F.least("label", "further").alias("label"))
        step = stored(step, f"components-{number}")
        label = step.select("node", "label")
        if step.where("label <> old").limit(1).count() == 0:
            return label
    raise RuntimeError("components did not settle")
