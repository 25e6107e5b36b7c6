"""Connected components of a table of links, by alternating large and small stars.

Both steps are a grouped minimum and a join on the same key: a hot node is combined before the
shuffle, and the minimum is dealt anew for the join, so that AQE can split the node's links there.
Every round is written, which cuts the lineage, and the round before is deleted; the number of
rounds grows with the logarithm of the links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import written
from tablewright.operators.joins import per_join_key


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = per_join_key(both, ["a"], F.min("b").alias("low")).select("a", F.least("low", "a").alias("low"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    least = per_join_key(down, ["a"], F.min("b").alias("low"))
    moved = down.join(least, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionAll(least.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root: every node of the links (a, b) and the smallest node of its component."""
    edges = written(links.select("a", "b").filter("a <> b").distinct(), "links")
    mark = None
    while True:
        edges = written(_small_star(_large_star(edges)), "links", instead_of=[edges])
        new = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum((F.xxhash64("a", "b") % 1000003))).first()
        if new == mark:
            break
        mark = new
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
