"""Connected components of links that grow with the corpus.

Alternating large-star and small-star steps (each a grouped minimum and a join)
turn any graph into stars whose centres are the smallest nodes, in a number of
rounds that grows with the logarithm of its size. Every round is written to the
shared scratch folder; only a count of changed links reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long), root the smallest
    node reachable. Loops, repeated links and either direction are accepted."""
    edges = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        # large star: every neighbour above a node is linked to its smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.filter("m < u").select("u", F.col("m").alias("v"))).distinct())
        large = materialize(large, "links")
        # small star: a node and its neighbours below it are linked to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = materialize(small, "links")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
