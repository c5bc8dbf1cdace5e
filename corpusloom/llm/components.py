"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

#: Rounds needed grow with the logarithm of the largest component; this many are never reached.
MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node points to the least of the node and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it point to the least of them: the node itself in that one's place."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """Label the nodes of links (a, b) with the least node of their component: ``node, component``.

    Only nodes with a link to another node appear. Links stay distributed; a round's edges are cut
    off by a checkpoint, and rounds end when the edges, all pointing at roots, no longer change.
    """
    edges = checkpoint(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    for _ in range(MAX_ROUNDS):
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
        edges = checkpoint(_small_star(_large_star(edges)))
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
