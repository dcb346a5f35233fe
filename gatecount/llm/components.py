"""Connected components of an edge table by alternating large and small stars.

Each round hangs every node on the smallest node it can see, from both sides, and writes
the edges to the shared folder; rounds end when no edge changes. The number of rounds
grows with the logarithm of the longest chain, and no node's edges come together in one task:
minima are aggregated, and the joins are ones whose large partitions Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import discard, saved

_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """node, root: for each node of ``edges`` (u, v), but the roots themselves, the smallest node it can reach."""
    now = saved(_down(edges.select(F.col("u").alias("a"), F.col("v").alias("b"))), "components", narrow=True)
    was = None
    for k in range(_ROUNDS + 1):
        stat = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if stat == was or not stat[0]:
            break
        if k == _ROUNDS:
            raise RuntimeError(f"components are not settled after {_ROUNDS} rounds")
        was = stat
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _down(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("a", "b", "m")
        small = small.select("a", F.col("m").alias("b")).unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
        before, now = now, saved(_down(small), "components", narrow=True)
        discard(before)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _down(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
