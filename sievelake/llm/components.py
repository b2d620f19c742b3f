"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelake.llm.storage import keep


def components(links: DataFrame) -> DataFrame:
    """node, component: the smallest node that can be reached. `links` has long columns a and b.

    First every node's links to smaller nodes are replaced by one to the smallest of them, which in turn is linked to
    the others: that keeps what is connected, and of many links between a group and its hubs leaves about one a
    node. Each turn then gives every node the smallest label among its own and its neighbours' and then the label
    of that label, so that chains halve. A turn is a written table; sums of labels show when nothing
    has changed. Minima are combined on the map side; a node with very many links is a key with one row on
    the label side, whose link side Spark can split.
    """
    down = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    least = down.groupBy("b").agg(F.min("a").alias("least"))
    hubs = down.join(least, "b").where("a <> least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    few = hubs.unionAll(least.select(F.col("least").alias("a"), "b")).distinct()
    both = keep(few.unionAll(few.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("seen"))
        )
        lower = labels.join(near, "node").select(
            "node", F.least("component", "seen").alias("component"), F.col("component").alias("before")
        )
        jump = lower.select(F.col("node").alias("component"), F.col("component").alias("next"))
        after = keep(
            lower.join(jump, "component").select("node", F.col("next").alias("component"), "before")
        )
        changed = after.where("component <> before").limit(1).count()
        labels = after.select("node", "component")
        if not changed:
            return labels
