"""Connected components of an edge table by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import Workspace


def components(edges: DataFrame, workspace: Workspace) -> DataFrame:
    """(node, label) for every end of an edge (a, b); label is the least node reachable.

    Each round every node takes the least label among itself and its neighbours,
    and then the label of that label; rounds are staged and end when none changes.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = workspace.stage(both.distinct(), "arcs")
    labels = workspace.stage(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels"
    )
    while True:
        seen = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        nearer = labels.join(seen, labels["node"] == seen["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("step")
        )
        nearer = workspace.stage(nearer, "nearer")
        target = nearer.select(F.col("node").alias("at"), F.col("step").alias("jump"))
        before = labels
        moved = workspace.stage(
            nearer.join(target, nearer["step"] == target["at"]).select("node", "old", F.col("jump").alias("label")),
            "labels",
        )
        workspace.drop(before, nearer)
        if moved.where("old != label").isEmpty():
            workspace.drop(both)
            return moved.select("node", "label")
        labels = moved
