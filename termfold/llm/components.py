"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfold.session import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of the edges ``x, y``.

    Every node takes the smallest label among its own and its neighbours', then the label of that label, until nothing
    changes. Labels and edges are stored tables, so a node with very many edges is split by the join, and its
    neighbours' labels are reduced before they are moved.
    """
    both = edges.select(F.col("x").alias("node"), F.col("y").alias("other"))
    both = stored(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "edges")
    labels = stored(both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "labels")
    while True:
        seen = labels.select(F.col("node").alias("other"), F.col("component").alias("seen"))
        nearest = both.join(seen, "other").groupBy("node").agg(F.min("seen").alias("seen"))
        closer = labels.join(nearest, "node").select("node", "component", F.least("component", "seen").alias("new"))
        closer = stored(closer, "closer_labels")
        of_label = closer.select(F.col("node").alias("new"), F.col("new").alias("jumped"))
        jumped = closer.join(of_label, "new", "left")
        labels = jumped.select("node", "component", F.least("new", "jumped").alias("next"))
        labels = stored(labels, "labels")
        changed = labels.where("component <> next").limit(1).count()
        labels = labels.select("node", F.col("next").alias("component"))
        if not changed:
            return labels
