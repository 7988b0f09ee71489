"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnflow.session import checkpoint_root


def _smaller_neighbour(links: DataFrame) -> DataFrame:
    """Links every node's larger neighbours to its smallest one (itself included)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (
        both.where("b > a").join(least, "a").where("b <> least")
        .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    )


def _to_smallest(links: DataFrame) -> DataFrame:
    """Links a node (the larger end, ``a``) and all its smaller neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of a link can reach. ``links`` has columns a and b.

    Two steps take turns, one moving larger neighbours, one smaller ones, until every link ends at its root; the number of
    rounds grows with the logarithm of the longest path. Each round is checkpointed, so a lost executor costs one round.
    """
    checkpoint_root(links.sparkSession)
    now = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    state = None
    while True:
        now = _to_smallest(_smaller_neighbour(now)).checkpoint()
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = seen
