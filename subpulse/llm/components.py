"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subpulse.session import settle


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; nodes share a root exactly if a path joins them.

    Every round points each node at the smallest of its neighbours and itself,
    follows that pointer once more, and replaces nodes by where they point. Nodes
    should be hash values: then a constant share of the remaining nodes goes in
    every round, also along chains. All tables are settled in the shared folder,
    so the lineage stays short and lost executors cost one round at most. Without
    edges the result is empty.
    """
    rest = settle(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "edges")
    roots = rest.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    started = False
    while not rest.isEmpty():
        both_ways = rest.union(rest.select("b", "a"))
        parent = settle(both_ways.groupBy("a").agg(F.least("a", F.min("b")).alias("up")), "parents")
        above = parent.select(F.col("a").alias("up"), F.col("up").alias("top"))
        step = settle(parent.join(above, "up").select(F.col("a").alias("node"), F.col("top").alias("root")), "steps")
        to = step.select(F.col("node").alias("a"), F.col("root").alias("to"))
        if started:
            on = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = roots.join(on, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        else:
            roots, started = step, True
        roots = settle(roots, "roots")
        moved = rest.join(to, "a").select(F.col("b").alias("a"), F.col("to").alias("x")).join(to, "a")
        rest = settle(moved.select(F.least("x", "to").alias("a"), F.greatest("x", "to").alias("b"))
                      .filter("a <> b").distinct(), "edges")
    return roots
