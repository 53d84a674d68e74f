"""Connected components of an edge table by alternating large and small stars.

Every round maps edges to their neighbourhoods' minima with partial aggregation and is
written to the shared folder, so lineage stays short and a lost executor costs a round at
most. Hot centres are rows to be split by the join, never lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisk.llm.store import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.join(low, "a").filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(low, "a")
    return (joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges to (a, root): every node that is not its component's least, with that least.

    Self-loops and repeated edges are ignored; no edges give no rows.
    """
    edges = materialize(edges.filter(F.col("a") != F.col("b"))
                        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "stars")
        row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(row) == mark:
            return edges.select("a", F.col("b").alias("root"))
        mark = tuple(row)
