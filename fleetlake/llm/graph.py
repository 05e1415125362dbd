"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import discard, staged


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of ``edges`` (a, b).

    Rounds take each node's smallest neighbour label and then the label of that label, until none changes; every
    round's labels are a written table. Hubs are reduced map-side, and both sides of each join are plain
    tables, so AQE can split a label or hub that many rows share.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = staged(both, "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        nearer = staged(labels.join(near, labels["node"] == near["a"])
                        .select("node", F.col("label").alias("was"), F.least("label", "near").alias("label")), "labels")
        jump = nearer.select(F.col("node").alias("to"), F.col("label").alias("further"))
        jumped = staged(nearer.join(jump, nearer["label"] == jump["to"]).select("node", "was", F.least("label", "further").alias("label")), "labels")
        discard(labels, nearer)
        labels = jumped
        if not jumped.where("label < was").limit(1).count():
            discard(both)
            return labels
        labels = staged(jumped.select("node", "label"), "labels")
        discard(jumped)
