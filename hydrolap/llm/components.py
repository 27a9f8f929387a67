"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import work_table


def components(edges: DataFrame, name: str = "components", folder: str | None = None) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); label: the smallest node that links reach.

    Each round offers the least label among a node's neighbours to the node and to its label, and then takes the label's own
    label, so that long chains shorten by doubling. Rounds are written to the shared folder; minima are taken before the shuffle, so a hub is one small group.
    They stay unless they go to a work ``folder``.
    """
    both = work_table(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges", folder)
    lowest = both.groupBy("a").agg(F.min("b").alias("low"))
    labels = work_table(lowest.select(F.col("a").alias("node"), F.least("a", "low").alias("label")), f"{name}-0", folder)
    turn = 0
    while True:
        turn += 1
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("low"))
        offers = labels.join(near, F.col("node") == F.col("a")).select(F.inline(F.array(
            F.struct("node", F.col("low").alias("offer")), F.struct(F.col("label").alias("node"), F.col("low").alias("offer")))))
        best = offers.groupBy("node").agg(F.min("offer").alias("offer"))
        better = labels.join(best, "node").select("node", F.col("label").alias("old"), F.least("label", "offer").alias("label"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("beyond"))
        moved = better.join(jump, F.col("label") == F.col("via")).select("node", "old", F.least("label", "beyond").alias("label"))
        after = work_table(moved, f"{name}-{turn}", folder)
        labels = after.select("node", "label")
        if not after.where("label < old").limit(1).count():
            return labels
