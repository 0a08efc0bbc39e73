"""Connected components by hooking and pointer jumping, as joins and partial minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of edges (a, b): label is the smallest node that can be reached.

    In each round every node hooks onto the smallest of its smaller neighbours, chains are halved until all
    point to their roots, and the edges are contracted to roots; it ends when none is left. Hubs cost no more
    than partial minima. Tables of each round lie in the shared folder. No edges give an empty table.
    """
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        hooks = staged(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), "hooks")
        while True:
            up = hooks.select(F.col("node").alias("label"), F.col("label").alias("upper"))
            nearer = staged(hooks.join(up, "label", "left").select("node", F.coalesce("upper", "label").alias("label"), F.col("upper").isNotNull().alias("moved")), "hooks")
            hooks = nearer.select("node", "label")
            if nearer.where("moved").isEmpty():
                break
        if labels is None:
            labels = hooks
        else:
            up = hooks.select(F.col("node").alias("label"), F.col("label").alias("upper"))
            labels = staged(labels.join(up, "label", "left").select("node", F.coalesce("upper", "label").alias("label")).unionByName(hooks.join(labels, "node", "left_anti")), "labels")
        a = hooks.select(F.col("node").alias("a"), F.col("label").alias("to_a"))
        b = hooks.select(F.col("node").alias("b"), F.col("label").alias("to_b"))
        edges = edges.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"))
        edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = labels.select("label").distinct().select(F.col("label").alias("node"), "label").join(labels, "node", "left_anti")
    return labels.unionByName(roots)
