"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links(a, b); component is the smallest node reachable.

    Alternates large-star and small-star steps until nothing changes.  Each step takes the
    smallest neighbour with a map-side minimum and joins it back, so a node with very many
    links is a skewed join that adaptive execution splits, never a collected group.  Links
    with a null end, loops and repeated links are of no effect; no links give no rows.
    """
    a, b = F.col("a"), F.col("b")
    edges = stored(
        links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links"
    )
    before = _mark(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "links")
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(a.alias("node"), b.alias("component")).union(edges.select(b, b).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of those neighbours."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
