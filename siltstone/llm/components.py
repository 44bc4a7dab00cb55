"""Connected components of a link table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b), a > b: each node's neighbours are hung on its smallest one.

    large: a node moves its larger neighbours; else its smaller ones and itself. The minimum per
    node is aggregated before the shuffle and written, so that the join has two plain sides and a
    node with very many neighbours is split at run time.
    """
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star-min")
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a > b").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): for every node that has a link to another one, the smallest node it can reach.

    Nodes are numbers or texts. Links of a node to itself, repeated links and links with a null count as
    none; without links the result is empty. Each round is written to the shared folder, and only
    its row count and checksum come to the driver. The rounds grow with the logarithm of the nodes.
    """
    x, y = F.col(a), F.col(b)
    edges = materialize(links.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = materialize(_star(materialize(_star(edges, True), "star-large"), False), "star-small")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
