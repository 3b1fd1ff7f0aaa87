"""Connected components of an edge table by minimum labels with pointer jumping; all state stays in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.sources.scratch import materialize

MAX_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for each node of the edges ``a``, ``b``.

    Each round lets a node take the smallest label among itself, its neighbours and its label's label, so labels travel
    twice as far each time. Only minima are shuffled, with partial aggregation, so hubs are not gathered.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")), "labels")
    for _ in range(MAX_ROUNDS):
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        hopped = labels.join(near, labels.node == near.a).select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        hopped = materialize(hopped, "labels")
        up = hopped.select(F.col("node").alias("up"), F.col("root").alias("up_root"))
        jumped = hopped.join(up, hopped.root == up.up).select("node", "old", F.least("root", "up_root").alias("root"))
        jumped = materialize(jumped, "labels")
        labels = jumped.select("node", "root")
        if jumped.where("root <> old").isEmpty():
            return labels
    raise RuntimeError(f"labels still change after {MAX_ROUNDS} rounds")
