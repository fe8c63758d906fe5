"""Connected components by alternating stars, on edges that never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (the least node of its component) for the nodes of edges (a long, b long).

    Each round lets every node's larger neighbours, then its smaller ones, point to the least neighbour; each
    round is written to the shared folder, and the one before it deleted. Loops and repeated edges do no harm; nodes without an edge are not in
    the result. The number of rounds grows with the logarithm of the nodes."""
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        last, now = now, stored(small.filter("u <> v").distinct(), "edges")
        discard(last)
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
