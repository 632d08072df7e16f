"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.sources.shared import materialise


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a``, ``b``): the smallest node of its component.

    A round gives every node its smallest neighbour as parent, follows parents
    once more, and contracts the links; stars vanish in one round and the number
    of rounds grows with the logarithm of the longest path. Each round is
    written to the shared folder.
    """
    edges = materialise(links.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), "links")
    nodes: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = materialise(
            both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("parent")),
            "link-parents",
        )
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = materialise(parents.join(up, "parent").select("node", F.col("above").alias("component")), "link-jumps")
        if nodes is None:
            nodes = jumped
        else:
            step = jumped.select(F.col("node").alias("component"), F.col("component").alias("above"))
            nodes = nodes.join(step, "component", "left").select("node", F.coalesce("above", "component").alias("component"))
            nodes = materialise(nodes, "link-nodes")
        side = lambda c: jumped.select(F.col("node").alias(c), F.col("component").alias(f"{c}_up"))  # noqa: B023, E731
        edges = materialise(
            edges.join(side("a"), "a")
            .join(side("b"), "b")
            .filter("a_up != b_up")
            .select(F.greatest("a_up", "b_up").alias("a"), F.least("a_up", "b_up").alias("b"))
            .distinct(),
            "links",
        )
    if nodes is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes
