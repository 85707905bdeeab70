"""Connected components of an edge table.

Large-star and small-star steps alternate until nothing changes: each node
moves its edges to the smallest node it knows.  A step is an aggregation and a
join on the node; edges only ever point at fewer and smaller nodes, and a
component ends as a star around its smallest node.  Every round is written to the
shared scratch folder, so lineage stays short and lost executors cost one round.
A node with very many edges is split by adaptive skew handling on the join, and
the aggregation is partial before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histdim.llm.frames import stored


def _least(edges: DataFrame) -> DataFrame:
    """(node, least neighbour) of edges (a, b)."""
    return edges.groupBy("a").agg(F.min("b").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).withColumn("least", F.least("a", "least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have a > b."""
    least = _least(edges)
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a != b")
    return moved.unionAll(least.select("a", F.col("least").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b) that isn't its component's root,
    the smallest node of the component."""
    edges = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   "edges")
    seen = None
    while True:
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
