"""Connected components of large edge tables, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliowright.llm.common import FEW, materialised, remove_path


def _both_ways(edges: DataFrame) -> DataFrame:
    """(a, b) and (b, a) of each edge, in the edges' own partitions, which a union would add up."""
    return edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a")
    return moved.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))


def components(edges: DataFrame, rounds: int = 60, few: int = FEW) -> DataFrame:
    """(node, component): the least node reachable, for every node of an edge.

    Each round replaces a node's larger neighbours' links by links to its least one, and
    then its own by links to the least; the rounds needed grow with the logarithm of the
    edges. A node's neighbours are only aggregated and joined, never gathered. State
    between rounds is a table in the shared folder, so that the planner knows its size.
    Up to `few` edges, which should be a table that is written already, are read by one
    task, whose rows need no exchange; a round never has more edges than the one before.
    """
    edges = edges.select("a", "b").where("a <> b")
    small = edges.limit(few + 1).count() <= few
    last = path = None
    # asked for again behind each join, of whose rows the planner no longer knows that one task has them
    dealt = (lambda df: df.coalesce(1)) if small else (lambda df: df)
    for _ in range(rounds):
        larger = dealt(_large_star(dealt(edges))).distinct()
        edges, done = materialised(dealt(_small_star(larger)).where("a <> b").distinct(), "edges")
        if path:
            remove_path(edges.sparkSession, path)
        path = done
        state = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if state == last:
            ends = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("component")), F.struct(F.col("b").alias("node"), F.col("b").alias("component")))
            return dealt(edges).select(F.inline(ends)).distinct()
        last = state
    raise RuntimeError(f"components not found in {rounds} rounds")
