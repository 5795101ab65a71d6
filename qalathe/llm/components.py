"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import forget, saved


def _renamed(table: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """``column`` replaced by its parent, where it has one."""
    known = parents.select(F.col("node").alias(column), F.col("parent").alias("__parent"))
    return table.join(known, column, "left").withColumn(column, F.coalesce("__parent", column)).drop("__parent")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of ``links``; the component is its smallest node.

    Each round hooks every node to its smallest neighbour, follows such hooks two steps further,
    and moves the links to where their ends went, until no link is left between different
    nodes. A hook never leaves its component, and the smallest node stays. All tables of a round
    are written, so a lost executor repeats a scan.
    """
    edges = saved(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v"), "links")
    nodes = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = saved(
            both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("__v"))
            .select("node", F.least("__v", "node").alias("parent")), "hooks")
        jumped = saved(_renamed(_renamed(hooks, "parent", hooks), "parent", hooks), "hooks")
        moved = _renamed(_renamed(edges, "u", jumped), "v", jumped).where("u <> v").select(
            F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        following = saved(moved, "links")
        if nodes is None:
            reached = saved(jumped.select("node", F.col("parent").alias("component")), "components")
        else:
            reached = saved(_renamed(nodes, "component", jumped), "components")
            forget(nodes)
        forget(edges, hooks, jumped)
        edges, nodes = following, reached
    if nodes is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes
