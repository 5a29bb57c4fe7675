"""Connected components of a graph given as pairs, by repeated minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelbeam.llm.common import checkpointed


def connected(pairs: DataFrame) -> DataFrame:
    """Rows node, component (the least node reachable) for the nodes of ``pairs`` (a, b).

    Every round takes the least label among the neighbours and then the label of that label, so
    the rounds grow with the logarithm of a component's width, not with the number of nodes."""
    edges = checkpointed(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
                         .filter("a <> b").distinct())
    labels = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component"))
    while True:
        labels = checkpointed(labels)
        near = edges.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("near"))
        stepped = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("component").alias("was"), F.least("component", "near").alias("now"))
        jump = labels.select(F.col("node").alias("now"), F.col("component").alias("beyond"))
        moved = checkpointed(stepped.join(jump, "now", "left").select(
            "node", "was", F.least("now", F.coalesce("beyond", "now")).alias("component")))
        changed = moved.filter("was <> component").limit(1).count()
        labels = moved.select("node", "component")
        if not changed:
            return labels
