"""Joins over neighbour sets and positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom import session as settings
from linkloom.functions.scalars import tile_distance_sq
from linkloom.operators.history import broadcast_if_small


def neighbor_delta(known: DataFrame, in_range: DataFrame) -> DataFrame:
    """Peers that departed (known, no longer in range) and arrived (in range, not yet known).

    One aggregate over both sets instead of two anti joins: a single shuffle,
    combined before it.
    """
    tagged = known.select("node", "peer", F.lit(1).alias("side")).unionByName(
        in_range.select("node", "peer", F.lit(2).alias("side"))
    )
    sides = tagged.groupBy("node", "peer").agg(
        F.min("side").alias("least"), F.max("side").alias("most")
    )
    change = F.when(F.col("least") == 1, "departed").otherwise("arrived")
    return sides.where(F.col("least") == F.col("most")).select("node", "peer", change.alias("change"))


def topology_change(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Nodes whose neighbour set no longer matches the one last reported.

    A different size is reported first; with equal sizes, the smallest unseen peer.
    """
    tagged = previous.select("node", "peer", F.lit(1).alias("side")).unionByName(
        current.select("node", "peer", F.lit(2).alias("side"))
    )
    pairs = tagged.groupBy("node", "peer").agg(
        F.min("side").alias("least"), F.max("side").alias("most")
    )
    nodes = pairs.groupBy("node").agg(
        F.count_if(F.col("least") == 1).alias("was"),
        F.count_if(F.col("most") == 2).alias("now"),
        F.min(F.when(F.col("least") == 2, F.col("peer"))).alias("unseen"),
    )
    resized = F.col("was") != F.col("now")
    note = F.when(
        resized, F.concat(F.col("was").cast("string"), F.lit(" → "), F.col("now").cast("string"), F.lit(" neighbors"))
    ).otherwise(F.concat(F.lit("peer "), F.col("unseen").cast("string"), F.lit(" replaced a neighbor")))
    return nodes.where(resized | F.col("unseen").isNotNull()).select(
        "node", F.lit("topology").alias("change"), note.alias("note")
    )


def _cell(c: Column, radius: float) -> Column:
    return F.floor(c / radius).cast("bigint")


def proximity_pairs(
    df: DataFrame, radius: float = 15, mesh: str = "t", crowd: int | None = None
) -> DataFrame:
    """Pairs of nodes of one mesh instant within ``radius`` tiles.

    Nodes meet in grid cells of that size: one side stays in its cell, the other
    is offered to its own cell and half the ring around it, so only near neighbours are compared.
    A cell with more than ``crowd`` nodes is cut into stripes: its resident rows
    are spread over them and the visitors copied to each, which splits the work
    and compares every pair exactly once.
    """
    crowd = crowd or min(10_000, settings.hot_rows(df.sparkSession))
    placed = df.select(
        F.col(mesh).alias("_t"), "node", "x", "y",
        _cell(F.col("x"), radius).alias("_cx"), _cell(F.col("y"), radius).alias("_cy"),
    )
    cell = ["_t", "_cx", "_cy"]
    # Half of the ring around a cell, so that two cells meet once.
    ring = F.array(*[
        F.struct(F.lit(dx).cast("bigint").alias("dx"), F.lit(dy).cast("bigint").alias("dy"))
        for dx, dy in [(0, 0), (1, 0), (-1, 1), (0, 1), (1, 1)]
    ])
    visitor = placed.withColumn("_step", F.explode(ring)).withColumns(
        {"_cx": F.col("_cx") + F.col("_step.dx"), "_cy": F.col("_cy") + F.col("_step.dy")}
    )
    resident = placed
    crowded = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > crowd)
    if not crowded.isEmpty():
        crowded = broadcast_if_small(
            crowded.select(*cell, F.ceil(F.col("_n") / crowd).cast("int").alias("_cuts"))
        )
        cuts = F.coalesce(F.col("_cuts"), F.lit(1))
        resident = resident.join(crowded, cell, "left").withColumn(
            "_stripe", F.pmod(F.xxhash64("node"), cuts).cast("int")
        )
        visitor = visitor.join(crowded, cell, "left").withColumn(
            "_stripe", F.explode(F.sequence(F.lit(0), cuts - 1))
        )
        cell = cell + ["_stripe"]
    left = resident.select(*cell, F.col("node").alias("_a"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    right = visitor.select(
        *cell, F.col("node").alias("_b"), F.col("x").alias("bx"), F.col("y").alias("by"), "_step"
    )
    gap = tile_distance_sq("ax", "ay", "bx", "by")
    at_home = (F.col("_step.dx") == 0) & (F.col("_step.dy") == 0)
    near = left.join(right, cell).where(
        (~at_home | (F.col("_a") < F.col("_b"))) & (gap <= radius * radius)
    )
    return near.select(
        F.col("_t").alias(mesh),
        F.least("_a", "_b").alias("a"),
        F.greatest("_a", "_b").alias("b"),
        F.sqrt(gap.cast("double")).alias("dist"),
    )
