"""Connected components of a link table, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import drop_written, written


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; ``root`` is the smallest node that it reaches.

    Each round a node takes the smallest root among its neighbours' and hangs its old root
    below it, then skips to its root's root; the rounds end when nothing changes. No node
    gathers its neighbours: minima are combined before they are moved.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.distinct(), "edges")
    roots = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("root")), "roots")
    while True:
        seen = edges.join(roots.select(F.col("node").alias("b"), F.col("root").alias("near")), "b")
        best = seen.groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        own = roots.join(best, "node")
        # the root of a node with a smaller neighbour learns of it, too
        hung = own.where("near < root").groupBy(F.col("root").alias("node")).agg(F.min("near").alias("hang"))
        taken = written(own.join(hung, "node", "left").select(
            "node", F.col("root").alias("old"), F.least("root", "near", "hang").alias("root")), "taken")
        up = taken.select(F.col("node").alias("root"), F.col("root").alias("up"))
        jumped = written(taken.join(up, "root").select("node", "old", F.least("root", "up").alias("root")), "roots")
        drop_written(taken, roots)
        roots = jumped.select("node", "root")
        if jumped.where("old <> root").isEmpty():
            drop_written(edges)
            return roots


def relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels(node, label)`` after the links between nodes join their labels."""
    at = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias("l" + side))
    edges = (links.join(at("a"), "a").join(at("b"), "b").where("la <> lb")
             .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct())
    edges = written(edges, "label-links")
    if edges.isEmpty():
        return labels
    root = components(edges)
    moved = written(labels.join(root.withColumnRenamed("node", "label"), "label", "left")
                    .select("node", F.coalesce("root", "label").alias("label")), "labels")
    drop_written(edges, root)
    return moved
