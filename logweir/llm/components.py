"""Connected components of a table of links, by alternating stars; no list of neighbours is ever built."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.tables import written


def _done(edges: DataFrame) -> bool:
    """Whether every node has one edge (a, b) down at most, to a node that has none."""
    ends = F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("down")), F.struct(F.col("b").alias("node"), F.lit(0).alias("down")))
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("down").alias("down"), F.count("*").alias("ends"))
    return nodes.filter("down > 1 or (down = 1 and ends > 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (a, b): the smallest node it is connected with.

    Each round joins every larger neighbour of a node with the smallest one, then every smaller one; both are a
    minimum by node and a join with it, so that a hub's links are spread like any skewed join's.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _done(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        kept = small.select("a", F.col("m").alias("b"))
        moved = small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(kept.unionByName(moved).distinct(), "links")
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own)
