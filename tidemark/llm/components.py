"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every edge leads straight to a smallest node: one per u, and no v is a u."""
    roles = edges.select(F.col("u").alias("node"), F.lit(1).alias("u")).unionAll(
        edges.select(F.col("v").alias("node"), F.lit(None).cast("int").alias("u"))
    )
    uses = roles.groupBy("node").agg(F.count("u").alias("as_u"), F.count(F.lit(1)).alias("all"))
    return uses.filter("as_u > 1 OR as_u = 1 AND all > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (u, v): the smallest node reachable.

    Neighbourhoods are never gathered: a star takes a minimum, combined before the shuffle,
    and a join that adaptive execution splits where one node has very many neighbours.  The
    rounds grow with the logarithm of the longest path.  Loops and repeated edges are
    harmless; nodes without edges do not appear; no edges give no rows.
    """
    now = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stored(now.distinct(), "edges")
    while not _is_stars(now):
        now = stored(_small_star(_large_star(now)), "edges")
    member = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centre = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return member.unionAll(centre)
