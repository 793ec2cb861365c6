"""Connected components of a link table, by alternating stars, until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox import workspace


def _directed(links: DataFrame, low: str, high: str) -> DataFrame:
    return links.select(F.least(low, high).alias("lo"), F.greatest(low, high).alias("hi")).where("lo < hi").distinct()


def _signature(links: DataFrame) -> tuple:
    """Count and an order-free sum over the links: two numbers for the driver, whatever the size."""
    mark = F.xxhash64("lo", "hi").cast("decimal(20,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(mark)).first())


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): each linked node with the smallest node of its component; unlinked nodes are not listed.

    A round is a large star (every higher neighbour of a node joins the node's smallest neighbour) and a small star
    (every lower neighbour joins the smallest one), which keeps the number of links and halves distances. Each step
    takes a minimum per node, combined before it is shuffled, and one equi join, so that a node with very many links
    is split like any skewed key. Rounds end when the links no longer change; each is written to the shared folder, which cuts its lineage.
    """
    edges = workspace.stored(_directed(links, left, right), "links")
    before = _signature(edges)
    while before[0]:
        # Large star: for node u, neighbours v > u are linked to min(u, neighbours).
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        upper = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        edges = _directed(upper.join(least, "u").select("m", "v"), "m", "v")
        # Small star: for node u, lower neighbours and u itself are linked to the lowest one.
        lowest = edges.groupBy("hi").agg(F.min("lo").alias("m"))
        starred = edges.join(lowest, "hi").select("m", F.explode(F.array("lo", "hi")).alias("v"))
        edges = workspace.stored(_directed(starred, "m", "v"), "links")
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.union(edges.select("lo", "lo").distinct())
