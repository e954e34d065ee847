"""Connected components of an undirected graph by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.llm.common import discard, save

MOST_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the smallest node of its component.

    Each round costs a few shuffles of the edges and writes them to the shared folder; the number of rounds
    grows with the logarithm of a component's size. It raises if rounds do not settle.
    """
    e = save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
             "edges")
    before = None
    for _ in range(MOST_ROUNDS):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b")))
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        old, e = e, save(small, "edges")
        discard(old)
        now = _state(e)
        if now == before:
            roots = e.select("b").distinct()
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                roots.select(F.col("b").alias("node"), F.col("b").alias("root")))
        before = now
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
