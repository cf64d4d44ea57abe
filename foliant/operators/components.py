"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.staging import stage


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label: the smallest node of each linked node's component; nodes of any orderable type.

    Every node looks at the smallest label among its neighbours, and labels are followed to their own labels
    (pointer jumping), until nothing changes: rounds grow with the logarithm of the longest chain. Each round is staged.
    """
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a != b")
    both = stage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("seen"))
        step = labels.join(near, "node", "left").select("node", F.least("label", F.coalesce("seen", "label")).alias("label"))
        up = step.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        new = stage(step.join(up, "label", "left").select("node", F.least("label", F.coalesce("higher", "label")).alias("label")))
        changed = new.join(labels.select("node", F.col("label").alias("old")), "node").where("label != old").limit(1).count()
        labels = new
        if not changed:
            return labels
