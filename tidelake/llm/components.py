"""Connected components of a link table, distributed throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each linked node reaches. Nodes without links are absent.

    Alternates the large-star and small-star steps of map-reduce component search. Each step needs the least neighbour of a
    node, an aggregate that combines before its shuffle, so a node of very many links costs no task its list of neighbours.
    Each round is written to the shared folder; the rounds grow with the logarithm of a component's size.
    Null ends and links of a node with itself are left out.
    """
    plain = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    plain = plain.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = Saved(plain, "cc")
    while not _stars(now.df):
        for star in (_large_star, _small_star):
            step = Saved(star(now.df), "cc")
            now.drop()
            now = step
    roots = now.df.select(F.col("v").alias("node")).distinct()
    return now.df.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.withColumn("component", F.col("node")))


def _stars(edges: DataFrame) -> bool:
    """Whether each larger end has one smaller neighbour, which has none: then that is the component."""
    down = edges.groupBy("u").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    if down.where("lo < hi").limit(1).count():
        return False
    return not edges.select("v").distinct().join(edges.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi").limit(1).count()


def _least(edges: DataFrame) -> DataFrame:
    """(w, m): nodes with a smaller neighbour, and the least of those. It is a table of its own, so that a join with it has plain
    shuffles on both sides, which Spark splits where a node has very many edges."""
    return Saved(edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), "least").df


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the node's least neighbour or the node itself. Edges come with u > v."""
    tied = edges.select(F.col("u").alias("big"), F.col("v").alias("node")).join(_least(edges), F.col("node") == F.col("w"), "left")
    return tied.select(F.col("big").alias("u"), F.coalesce("m", "node").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, is tied to the least of them. Edges come with u > v."""
    least = _least(edges)
    moved = edges.join(least, F.col("u") == F.col("w")).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select(F.col("w").alias("u"), F.col("m").alias("v")).unionByName(moved).distinct()
