"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.llm.common import stage


def _nearest(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours in (u, w). Partial minima keep a hub's
    neighbours from meeting in one task."""
    return edges.groupBy("u").agg(F.least(F.min("w"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("w")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("w")))
    return both.join(_nearest(both), "u").where("w > u and w <> m").select(F.col("w").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("w"))
    joined = down.join(_nearest(down), "u")
    lower = joined.where("w <> m").select(F.col("w").alias("a"), F.col("m").alias("b"))
    own = joined.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return lower.unionByName(own).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every child has one parent and no parent is a child (one small aggregate)."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.lit(1).alias("child"), F.lit(0).alias("parent")), F.struct(F.col("b").alias("v"), F.lit(0).alias("child"), F.lit(1).alias("parent")))).alias("e")).select("e.*")
    seen = ends.groupBy("v").agg(F.sum("child").alias("c"), F.max("parent").alias("p"))
    return seen.agg(F.max(F.col("c") + F.when(F.col("c") > 0, F.col("p")).otherwise(0))).first()[0] in (None, 1)


def components(links: DataFrame) -> DataFrame:
    """(v, component) for every end of the links (a, b); component is its smallest vertex.
    Each round is staged; rounds go on until the edges are stars around their smallest vertices,
    which takes a number of rounds that grows with the logarithm of the component size."""
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    while not _is_stars(edges):
        edges = stage(_small_star(_large_star(edges)), "components")
    roots = edges.select(F.col("b").alias("v"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("v"), F.col("b").alias("component")).unionByName(roots).distinct()
