"""Connected components of an edge table by alternating star operations.

Large-star links every larger neighbour of a node to the smallest node of its neighbourhood, small-star does the same with
the smaller ones; both are grouped minima and one join, so no neighbourhood is ever held in one place.  Rounds end when each
component is a star around its smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordforge.llm.common import no_shuffles_left, saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (u, v): one star operation; edges come back as (larger, smaller), repeated ones too."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def _stars(edges: DataFrame) -> bool:
    """Whether all components of the distinct edges are stars around their smallest node: no node has two smaller neighbours, or smaller and larger ones."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    with no_shuffles_left(edges.sparkSession):
        return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of any ordered type -> (node, root): every node with an edge and the smallest node it reaches.

    Null ends and loops are left out; repeated edges change nothing; no edges give no rows.
    """
    edges = edges.where("a is not null and b is not null and a <> b")
    edges = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _stars(edges):
        # Repeated edges do no harm to a minimum; between the two operations they stay.
        edges = saved(_star(_star(edges, large=True), large=False).distinct())
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
