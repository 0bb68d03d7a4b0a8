"""Connected components of an edge table by alternating large-star and small-star steps.

Both steps group edges by one end with a minimum, which combines before the shuffle, and join the minimum back to the
edges. Nodes with more than ``HUB`` edges, and more than one in ``HUBS`` of all, are joined apart: there are at most ``HUBS`` of them, 1 MB, which go to all tasks, so
their edges stay where they are. Each round is a written table. Nothing is collected but a
count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.sources.staging import stage

#: Edges from which a node's may be joined apart, and the most nodes that are.
HUB, HUBS = 256, 1 << 16


def with_least(edges: DataFrame, limit: int) -> DataFrame:
    """Edges (a, b) with ``m``, the smallest b of their a; nodes with more edges than the limit are joined apart."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).withColumnRenamed("a", "_a")
    hubs = stage(least.where(F.col("n") > limit).select("_a", "m"), "hubs")
    same = F.col("a") == F.col("_a")
    if hubs.isEmpty():
        return edges.join(least.drop("n"), same).drop("_a")
    rest = edges.join(hubs.select("_a"), same, "left_anti").join(least.where(F.col("n") <= limit).drop("n"), same)
    return edges.join(hubs, same).drop("_a").unionByName(rest.drop("_a"))


def connected(edges: DataFrame) -> DataFrame:
    """(a, b) of longs -> (node, root) for every node with an edge but the roots; root is the smallest node of the component.

    Loops and repeated edges don't matter; no edge may hold a null.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = stage(edges.select(high, low).where("a > b").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        limit = max(HUB, 2 * state[0] // HUBS)
        large = with_least(both, limit).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        small = with_least(large, limit).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = stage(small.select("e.a", "e.b").where("a > b").distinct(), "edges")
