"""Connected components of a distributed graph by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest node reachable.

    Each round links every node's larger neighbours, then its smaller ones, to the least of
    them. Least neighbours come from an aggregation that combines before the shuffle and are
    joined back, so a node with very many neighbours is never gathered in one task. Rounds
    grow with the logarithm of the component size; each ends in a written table.
    """
    edges = checkpointed(_ordered(edges))
    before = None
    while (state := _state(edges)) != before:
        before = state
        edges = checkpointed(_ordered(_small_star(_large_star(edges))))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, each once."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()


def _state(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the edges."""
    checksum = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), checksum).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    edges = _ordered(edges)
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    linked = edges.join(least, "a")
    return linked.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
        least.select("a", F.col("least").alias("b"))
    )
