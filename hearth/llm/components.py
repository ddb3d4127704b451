"""Connected components of an edge table: union-find by large-star and small-star steps.

Every step is an aggregate and a join on nodes; nothing is collected, and the edge
table is written to the shared checkpoint folder after each round, so the lineage
stays short.  O(log^2) rounds in the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import written


def _stars(e: DataFrame) -> bool:
    """Whether each node is either a root or linked with one root alone."""
    ends = e.select("b", F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("a", F.lit(0), F.lit(1)))
    return ends.groupBy("b").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).filter(
        "up > 1 or (up > 0 and down > 0)").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links → (node, root): each node that occurs, with the smallest node of its component.

    Loops, repeated links and links with a null end add nothing.
    """
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    e = written(e, "cc-edges")
    while not _stars(e):
        # large star: the larger neighbours of a node move to the smallest of its neighbourhood
        n = e.union(e.select("b", "a")).toDF("u", "v")
        m = n.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = n.join(m, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        # small star: a node and its smaller neighbours move to the smallest of these
        large = written(large, "cc-large")
        s = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(s, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
                 .union(s.select(F.col("m").alias("a"), "b")).distinct())
        e = written(small, "cc-edges")
    return e.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        e.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
