"""Connected components of a large graph, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wickwork.llm.common import cut


def _stars(edges: DataFrame) -> DataFrame:
    """One round: every neighbour, and the vertex itself, is tied to the least of them (large star, then small star)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    # Now a > b in every row.
    least = larger.groupBy("a").agg(F.min("b").alias("m"))
    tied = larger.join(least, "a").select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b"))
    return tied.where("a <> b").distinct()


def _print(edges: DataFrame) -> tuple:
    """A digest of the edges, to see whether a round has changed them."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003), F.min(F.xxhash64("b", "a"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``a``, ``b``: every vertex that is not the least of its component, and the least.

    ``edges`` has ``a`` and ``b``. Each round is a few aggregations with partial sums and
    joins that Spark can split at hot vertices; the number of rounds grows with the logarithm
    of the components' width.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _print(edges)
    while True:
        edges = cut(_stars(edges))
        now = _print(edges)
        if now == seen:
            return edges
        seen = now
