"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.operators.joins import lookup
from foliant.session import durable


def _roots(edges: DataFrame) -> DataFrame:
    """Hook every node to its smallest neighbour if that is smaller: node, root."""
    both = edges.select("u", "v").unionByName(
        edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    )
    smallest = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v"))
    return smallest.select("node", F.least("node", "v").alias("root"))


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, component (smallest node id). ``nodes`` has node; ``edges`` has u, v.

    Each round hooks nodes to their smallest neighbour, flattens the resulting
    chains and contracts the edges, so the edge list shrinks geometrically.
    Every round is checkpointed; joins on hot roots go through ``lookup``.
    """
    labels = nodes.select("node", F.col("node").alias("component"))
    edges = durable(edges.filter("u <> v").distinct())
    while not edges.isEmpty():
        parents = durable(_roots(edges))
        while True:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
            lifted = durable(
                lookup(parents, up, "root").select("node", "root", "top")
            )
            parents = lifted.select("node", F.col("top").alias("root"))
            if lifted.filter("root <> top").isEmpty():
                break
        moved = parents.filter("node <> root")
        step = moved.select(F.col("node").alias("component"), F.col("root").alias("to"))
        unchanged = labels.join(step, "component", "left_anti")
        changed = lookup(labels, step, "component").select("node", F.col("to").alias("component"))
        labels = durable(unchanged.select("node", "component").unionByName(changed))
        for side in ("u", "v"):
            # Every node of the contracted graph has a parent row.
            renamed = parents.select(F.col("node").alias(side), F.col("root").alias(f"{side}2"))
            edges = lookup(edges, renamed, side).drop(side).withColumnRenamed(f"{side}2", side)
        edges = durable(edges.select("u", "v").filter("u <> v").distinct())
    return labels
