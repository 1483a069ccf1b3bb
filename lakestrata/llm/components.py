"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node reachable.

    Each round takes the least root among a node's neighbours and then the root's
    own root, so rounds grow with the logarithm of the longest path.  Roots that
    many nodes share meet as partial minima or in joins that Spark can split.
    Every round is written to the shared folder.
    """
    both = stage(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        "edges",
    )
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    labels = stage(labels.select("node", F.least("node", "root").alias("root")), "components")
    while True:
        near = (
            both.join(labels, both["a"] == labels["node"])
            .groupBy(F.col("b").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        hooked = labels.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root")
        )
        above = labels.select(F.col("node").alias("root"), F.col("root").alias("above"))
        after = stage(
            hooked.join(above, "root").select("node", "old", F.least("root", "above").alias("root")),
            "components",
        )
        labels = after.select("node", "root")
        if after.where("root <> old").isEmpty():
            return labels
