"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlens.session import cut_lineage

MAX_ROUNDS = 64


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``; component is the smallest node reachable.

    ``links`` holds pairs of comparable ids, in any order and any number of
    times; a self-link names its node; pairs with a null end are ignored.  The
    driver sees two numbers a round, a hub's links are aggregated before they
    are shuffled, and each round is checkpointed in the shared folder.  The
    number of rounds grows with the logarithm of the longest chain.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    loops = links.where("a = b").select(F.col("a").alias("node")).distinct()
    # an edge goes from the larger end u to the smaller end v
    edges = cut_lineage(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    alone = loops.join(edges.select(F.col("u").alias("node")), "node", "left_anti") \
        .select("node", F.col("node").alias("component"))
    return members.union(roots).union(alone).distinct()
