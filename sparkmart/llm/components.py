"""Connected components of an edge table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.store import written


def _digest(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges; one aggregate row."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, first: str, second: str, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node with a link; component is the least node that can be reached.

    Alternates two steps: every node links its larger neighbours to its least neighbour, then its smaller neighbours to the
    least. Both keep the components and end in stars around the least node, in about log(n) rounds whatever the shapes. A step
    is an aggregation that combines inside the tasks and a join on the node with one row on the right, so a node with very many
    links can be split by Spark. Rounds are written to the shared folder. Loops, repeated edges and NULL ends are dropped.
    """
    ends = edges.select(F.col(first).alias("x"), F.col(second).alias("y")).where("x <> y")
    links = written(ends.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links")
    seen = _digest(links)
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        links = written(small.where("a <> b").distinct(), "links")
        now = _digest(links)
        if now == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
