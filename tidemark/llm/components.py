"""Connected components by alternating stars: every round shuffles the edges, nothing meets on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import forget, put


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame):
    """Count and an order-free checksum of the edges: two numbers reach the driver."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(u, v)``; the component is its smallest node.

    Large-star and small-star steps alternate until the edges no longer change:
    then every node points at the smallest node of its component. Rounds grow
    with the logarithm of the component size. The edges of a round are written
    to the shared folder, those before it are deleted. A hub's smallest
    neighbour is a map-side minimum, and the join that spreads it is one that
    adaptive execution can split. Edges with a null end and loops are ignored;
    an empty table gives an empty table.
    """
    now = put(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        then = put(_small_star(_large_star(now).distinct()).distinct(), "edges")
        new = _mark(then)
        forget(now)
        now = then
        if new == mark:
            break
        mark = new
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
