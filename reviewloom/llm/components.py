"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm import common


def large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour (itself included)."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them; edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node that can be reached) for every node of links (a, b) that is not smallest itself.

    Each round is written to the shared folder; it ends when a round changes nothing.
    Links of a node with itself and repeated links do no harm.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    edges, before = common.kept_table(edges), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
        edges = common.kept_table(small_star(large_star(edges)))
