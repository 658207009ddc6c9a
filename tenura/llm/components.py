"""Connected components of an edge table with DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.session import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least node around it."""
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.min("b").alias("_m"))
    hung = both.where(F.col("b") > F.col("a")).join(least, "a")
    return hung.select(F.col("b").alias("a"), F.least("a", "_m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("_m"))
    hung = edges.join(least, "a")
    moved = hung.where(F.col("b") != F.col("_m")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return moved.unionByName(least.select("a", F.col("_m").alias("b")))


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node`` and ``component``, the least node that it reaches, for every node of an edge.

    Large-star and small-star steps alternate until no edge changes; their number grows with the logarithm of the
    longest path. A node's neighbours are only summed or joined, never gathered, and each round is stored, so a lost
    executor costs no more than a round. Edges with a null end and loops say nothing.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b")
    state = materialize(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        # Done when each node hangs below one root and no root hangs below another node.
        roots = state.select(F.col("b").alias("a")).distinct()
        tangled = state.groupBy("a").count().where("count > 1").select("a")
        if tangled.unionByName(state.select("a").join(roots, "a", "left_semi")).isEmpty():
            break
        starred = _small_star(_large_star(state).distinct()).distinct()
        state = materialize(starred, "edges")
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
