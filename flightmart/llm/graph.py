"""Connected components of a distributed edge table (union-find by minimum labels)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from flightmart.llm.common import hot_join, written


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; ``root`` is the least node reachable.

    Each round hooks every node to the least root among its neighbours and
    then jumps from root to root's root (path halving), so the rounds grow
    with the logarithm of the longest path. Tables stay distributed; each
    round is written to the shared folder, which cuts the lineage. Edges with
    a null end are ignored.
    """
    links = edges.where("a is not null and b is not null and a <> b")
    links = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "cc-links")
    total = links.count()
    # links are symmetric: a node's degree is the number of rows that name it on either side
    nearest = written(links.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("n")), "cc-nearest")
    degrees = nearest.select(F.col("a").alias("b"), "n")
    roots = nearest.select(F.col("a").alias("node"), F.least("a", "least").alias("root"))
    while True:
        offers = roots.select(F.col("node").alias("b"), F.col("root").alias("offer"))
        offered = hot_join(links, offers, ["b"], degrees, total, ["a"])
        offered = offered.groupBy(F.col("a").alias("node")).agg(F.min("offer").alias("offer"))
        hooked = roots.join(offered, "node", "left").select(
            "node", F.col("root").alias("old"), F.least("root", "offer").alias("mid"))
        jumped = hooked.join(roots.select(F.col("node").alias("mid"), F.col("root").alias("far")), "mid", "left")
        after = jumped.select("node", "old", F.least("mid", "far").alias("root"))
        seen = Observation()
        after = written(after.observe(seen, F.count_if(F.col("old") != F.col("root")).alias("moved")), "cc-roots")
        roots = after.select("node", "root")
        if not seen.get["moved"]:
            return roots
