"""Connected components of a table of edges, by hooking and pointer jumping over shrinking edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquetry.sources.scratch import Scratch


def relabel(df: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """`df` with the nodes of a column replaced by their labels; others stay."""
    new = labels.select(F.col("node").alias(column), F.col("label").alias("_label"))
    return df.join(new, column, "left").withColumn(column, F.coalesce("_label", column)).drop("_label")


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b): the least node of its component.

    Each round hooks every node to its least neighbour, jumps to the parent's parent, and goes on with the edges whose
    ends still differ under the new labels, until none is left. Labels only fall, so it ends; a path takes rounds in
    the order of the logarithm of its length. An empty table gives an empty one.
    """
    labels = None
    while True:
        both = edges.select("a", "b").union(edges.select("b", "a"))
        step = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up"))
        top = step.select(F.col("node").alias("up"), F.col("up").alias("top"))
        moved = scratch.table(step.join(top, "up", "left").select("node", F.coalesce("top", "up").alias("label")))
        labels = moved if labels is None else scratch.table(relabel(labels, "label", moved).select("node", "label"))
        ends = relabel(relabel(edges.select("a", "b"), "a", moved), "b", moved)
        edges, left = scratch.counted(ends.filter("a <> b"))
        if not left:
            return labels
