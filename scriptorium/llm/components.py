"""Connected components of a graph of edges, by contraction.

Every node points to the least of its neighbours and itself; pointers are followed to their ends by doubling;
edges are then drawn between these ends, and those within one are gone.  Rounds grow with the logarithm of the
nodes.  All tables are written to the shared folder, so a lost executor costs one step at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import maybe_broadcast, written


def _ends(parent: DataFrame) -> DataFrame:
    """node, root: pointers followed until they no longer move."""
    while True:
        onward = maybe_broadcast(parent.select(F.col("node").alias("root"), F.col("root").alias("onward")))
        moved = written(parent.join(onward, "root").select("node", F.col("root").alias("old"), F.col("onward").alias("root")), "pointers")
        parent = moved.select("node", "root")
        if not moved.where("root < old").take(1):
            return parent


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b, written.  -> node, root (one node of its component), for nodes with an edge; written."""
    labels = None
    while True:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = _ends(written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), "parents"))
        side = maybe_broadcast(parent)
        if labels is None:
            labels = parent
        else:
            labels = labels.join(side.select(F.col("node").alias("root"), F.col("root").alias("onward")), "root", "left")
            labels = written(labels.select("node", F.coalesce("onward", "root").alias("root")), "labels")
        drawn = edges.join(side.toDF("a", "x"), "a").join(side.toDF("b", "y"), "b").where("x != y")
        edges = written(drawn.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        if not edges.take(1):
            return labels
