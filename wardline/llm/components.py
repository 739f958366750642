"""Connected components of a graph given as edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardline.llm.common import empty
from wardline.sources.tables import materialise


def _larger(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours point at the least node of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    least = nearest.select("node", F.least("least", "node").alias("least"))
    larger = both.filter("b > a")
    return (
        larger.join(least, larger["a"] == least["node"])
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def _smaller(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point at the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    moved = down.join(least, down["a"] == least["node"]).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select(F.col("node").alias("a"), F.col("least").alias("b"))).filter("a <> b").distinct()


def _print_of(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
    ).first()
    return row["n"], row["sum"]


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of an edge: ``root`` is the least node of its component.

    ``edges`` has two bigint columns ``a`` and ``b``; repeats, loops and either direction are fine,
    rows with a null are left out. Rounds go on until nothing changes; their number grows with the logarithm of the
    component's size, and each is a few shuffles of the edges. Every round is written, so a lost
    executor costs no more than one round. A node with very many edges is met by aggregates that
    combine on the map side and by joins that adaptive execution can split.
    """
    spark = edges.sparkSession
    now = materialise(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(),
        "edges",
    )
    seen = _print_of(now)
    if not seen[0]:
        return empty(spark, "node bigint, root bigint")
    while True:
        now = materialise(_smaller(_larger(now)), "stars")
        after = _print_of(now)
        if after == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = after
