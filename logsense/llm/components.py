"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsense.session import materialize


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.sum((F.xxhash64("v", "u") % 1000003))
    ).first()
    return tuple(row)


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest one of the neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is its smallest node.

    Null ends and loops are ignored; an empty table gives an empty one. Each step groups by node with
    partial minima, so a hub with a third of all links is one row per task before the shuffle. Each
    step is a stored table. The loop ends when a round changes nothing: all links then point from a
    node to the smallest node of its component.
    """
    edges = materialize(
        edges.select("u", "v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    before = _fingerprint(edges)
    while before[0]:
        edges = materialize(small_star(materialize(large_star(edges), "large-star")), "small-star")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
