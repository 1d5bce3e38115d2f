"""Connected components by alternating stars, on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import removed, written


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
    return r["n"], r["x"]


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): root is the smallest node that it reaches.

    Each round hooks every node's larger neighbours to the smallest one it
    knows, then its smaller neighbours; trees get flat in a few rounds.  A
    round is two aggregates and two joins over the links; links and smallest
    neighbours are written, so an executor that is lost costs one step at most,
    and the joins are of plain exchanges, which Spark splits where a node is hot.
    Those of a round go when it ends.
    """
    edges = (links.where(F.col("a") != F.col("b"))
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    edges = written(edges, "components")
    before = None
    while (now := _state(edges)) != before:
        before = now
        if not now[0]:
            break
        # Large star: both directions; larger neighbours move to the smallest node around.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "components-least")
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        large = written(large, "components-large")
        removed(edges, least)
        # Small star: smaller neighbours, and the node itself, move to the smallest of them.
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "components-least")
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = written(small, "components")
        removed(large, least)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
