"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from acopio.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, with their number and the sum of their hashes, both taken on the way."""
    seen = Observation()
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    edges = stage(edges.observe(seen, F.count(F.lit(1)).alias("n"), digest.alias("digest")), "edges")
    return edges, (seen.get["n"], seen.get["digest"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge to another one.

    ``edges`` has long columns ``a`` and ``b``; edges with a null or to the node itself say
    nothing and are left out, repeats count once, no edges give no rows. ``component`` is the
    smallest node reachable. Each round is a few joins and sums over the edges, combined
    before they are shuffled; rounds grow with the logarithm of the longest path. Both halves
    of a round are written to the shared folder: as one plan the second half holds the first
    twice, and what the driver keeps of plans and tasks doubles with it.
    """
    edges = (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    edges, state = _written(edges)
    while state[0]:
        larger = stage(_large_star(edges).distinct(), "large-star")
        previous = state
        edges, state = _written(_small_star(larger).distinct())
        if state == previous:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
