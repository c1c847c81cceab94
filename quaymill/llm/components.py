"""Connected components of a distributed edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quaymill.sources.workspace import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to its least neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the least of them. Needs u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _settled(edges: DataFrame) -> bool:
    """Whether every upper node has one edge and is no other node's lower end. Needs u > v."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.max("down").alias("downs"))
    return nodes.agg(F.count_if(F.expr("ups > 1 OR ups > 0 AND downs > 0"))).first()[0] == 0


def components(edges: DataFrame, scratch: Scratch, name: str = "stars") -> DataFrame:
    """Rows (u, v): each node that is not the least of its component, with that least node.

    ``edges`` has two columns of one comparable type; loops, nulls and repeats are dropped. Minima
    per node fold before each shuffle. In the joins the edges of one node, pairs of numbers, meet in
    one task, as the aggregate shares the join's stage. Each round is written to the shared folder. The number
    of rounds grows with the logarithm of the longest chain; after each, one number reaches the driver.
    """
    a, b = (F.col(column) for column in edges.columns[:2])
    edges = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), (a == b).alias("loop"))
        .where(F.col("u").isNotNull() & F.col("v").isNotNull() & ~F.col("loop"))
        .select("u", "v")
        .distinct()
    )
    edges = scratch.keep(edges, f"{name}-0")
    rounds = 0
    while not _settled(edges):
        rounds += 1
        edges = _small_star(_large_star(edges)).distinct()
        edges = scratch.keep(edges, f"{name}-{rounds}")
    return edges
