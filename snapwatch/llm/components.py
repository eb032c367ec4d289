"""Connected components by alternating stars, on edges that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwatch.llm.tables import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smallest neighbour (or itself) to its larger neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smallest neighbour to itself and its other smaller neighbours; ``a`` is above ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    others = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return least.select("a", F.col("least").alias("b")).unionByName(others).distinct()


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mark)).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node that an edge names.

    Edges of NULL are left out; repeated edges and loops don't matter; no edges give no rows. Nodes may be of any
    type that has an order. The minimum over a node's neighbours is combined before it is shuffled and joined to
    the edges by Spark, which splits a node that has a great part of them. Rounds grow with the logarithm of the
    longest path.
    """
    from_, to = F.col(a), F.col(b)
    now = cut(
        edges.where(from_ != to).select(F.greatest(from_, to).alias("a"), F.least(from_, to).alias("b")).distinct()
    )
    state, before = _state(now), None
    while state != before:
        now = cut(_small_star(_large_star(now).distinct()))
        state, before = _state(now), state
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
