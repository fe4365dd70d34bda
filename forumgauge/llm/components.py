"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumgauge.llm.tables import Work


def _stars(edges: DataFrame) -> bool:
    """Whether each larger node has one link, to a node that has no smaller one: one grouping by node."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(links: DataFrame, work: Work, name: str, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest node) for every node that has a link to another.

    Alternates two contractions until only stars are left: each node passes the smallest
    node it knows to its larger neighbours, then to its smaller ones.  Only minima by
    node are grouped; the rows of a node with very many links are joined with one row,
    and such a join is one that adaptive execution splits.  Links are long pairs; nulls
    and loops are left out.
    """
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct())
    edges = work.keep(edges, f"{name}-0")
    step = 0
    while not _stars(edges):
        step += 1
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v"))
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small, "u")
        edges = work.keep(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
                          .union(small.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{step}")
        work.drop(f"{name}-{step - 1}")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
