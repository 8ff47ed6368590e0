"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texelframe.llm.common import stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that isn't the smallest of its component.

    Large-star and small-star steps in turn: each links the neighbours of a node to the
    smallest of them, until every component is a star. Both are joins with a partial
    aggregate; no node's neighbours are gathered, so that a node may have any number of them.
    Each round's edges are written to the shared folder; the rounds end when these are stars.
    """
    links = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter("hi <> lo").distinct()
    links = stored(links)
    while not _are_stars(links):
        both = links.union(links.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        links = stored(small.union(low.toDF("hi", "lo")).distinct())
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))


def _are_stars(links: DataFrame) -> bool:
    """Whether no node that hangs on a smaller one has any other link."""
    ends = links.select(F.col("hi").alias("node"), F.lit(1).alias("up")).union(links.select("lo", F.lit(0)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.count(F.lit(1)).alias("n"))
    return not nodes.agg(F.max((F.col("ups") > 0) & (F.col("n") > 1))).first()[0]
