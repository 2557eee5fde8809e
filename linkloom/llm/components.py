"""Connected components of a graph given as edges, by alternating large and small stars.

Every round hangs each node's larger neighbours, then its smaller ones, below the
smallest neighbour. Edges never outgrow the input, paths shorten fast, and at the end
every node points at its component's smallest. Rounds are written tables, so a lost
executor costs a part of one round only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm import common


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` lead from larger to smaller nodes and may repeat."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select("a", F.col("m").alias("b"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs below one other, and that one below none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    roles = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return not roles.where("below > 1 or below + above > 1").agg(F.count(F.lit(1))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node with an edge: node, component.

    ``edges(a, b)`` are undirected; loops, repeated edges and rows with a null are ignored.
    """
    down = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = common.stored(down.distinct(), "edges")
    while not _settled(now):
        now = common.stored(_small_star(_large_star(now)), "edges")
    tops = now.select(F.col("b").alias("node")).distinct()
    return common.stored(now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(tops.select("node", F.col("node").alias("component"))), "components")
