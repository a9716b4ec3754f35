"""Connected components of an undirected graph, by alternating large and small stars over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleloom.llm.common import stored
from titleloom.plans.sizing import gathered


def _are_stars(edges: DataFrame) -> bool:
    """Whether every ``a`` has one ``b``, and no ``b`` is an ``a``."""
    rows, ends = edges.agg(F.count("*"), F.count_distinct("a")).first()
    if rows != ends:
        return False
    return edges.select(F.col("b").alias("a")).distinct().join(edges, "a", "left_semi").isEmpty()


def _star(edges: DataFrame, most: int) -> DataFrame:
    """Lowest neighbour of every node, ``most`` nodes. It is stored, so that joins on it split hot nodes."""
    return stored(gathered(edges.groupBy("a").agg(F.min("b").alias("low")), most), "lowest")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes of ``edges(a, b)``: the lowest node that each one reaches.

    Lowest nodes have no row. Every round is written out; a round shuffles the edges twice, and the
    number of rounds grows with the logarithm of the longest path. No round has more edges than the first, whose
    number says how many files are written; ``edges`` is read twice, so give a stored table.
    """
    most = edges.count()
    ends = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = stored(gathered(edges.filter("a <> b").select(*ends).distinct(), most), "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_star(both, 2 * most), "a").filter("b > a")
        large = large.select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
        edges = stored(gathered(large.distinct(), most), "edges")
        lowest = _star(edges, most)
        small = edges.join(lowest, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.unionByName(lowest.withColumnRenamed("low", "b")).distinct()
        edges = stored(gathered(small, most), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
