"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from affinity.llm.store import Store


def connected_components(edges: DataFrame, store: Store, a: str = "a", b: str = "b", rounds: int | None = None) -> DataFrame:
    """(node, label) of every node of an edge, label the smallest node reached.
    With ``rounds`` it may stop before: equal labels are then connected, but
    not all connected nodes have equal labels.

    Every round each node takes the smallest label next to it, then the label
    of that label, so long paths halve.  Minima combine map-side and hot nodes
    are split by skew joins, so a star of any size is no hot task."""
    both = store.keep(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).union(
        edges.select(F.col(b), F.col(a))).distinct(), "edges")
    labels = store.keep(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("label")), "labels")
    done = 0
    while True:
        near = both.join(labels, both.u == labels.node).groupBy(F.col("v").alias("node")).agg(F.min("label").alias("near"))
        low = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("jump"))
        step = store.keep(low.join(up, "low", "left").select("node", F.least("low", "jump").alias("new"), "label"), "labels")
        done += 1
        changed = done != rounds and not step.where("new <> label").isEmpty()
        store.drop(labels)
        labels = step.select("node", F.col("new").alias("label"))
        labels.stored_at = step.stored_at
        if not changed:
            store.drop(both)
            return labels
