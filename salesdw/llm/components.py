"""Connected components by alternating star contraction; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesdw.staging import Staging


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Tie each node's larger (or its not larger) neighbours to the smallest of itself and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger:
        both = both.where("a > b")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    joined = both.join(least, "a")
    moved = joined.where("b > a" if larger else "b != least").select("b", "least")
    if not larger:
        moved = moved.unionByName(least.select(F.col("a").alias("b"), "least"))
    return moved.where("b != least").select(F.col("least").alias("a"), "b").distinct()


def components(edges: DataFrame, staging: Staging, rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked to, for the nodes of ``edges`` (a, b: long, not null).

    Nodes that are their own root are left out. Link order and repeats do not matter.
    """
    current = staging.put(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    size = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    before = current.agg(size).first()[0]
    for number in range(rounds):
        if before[0] == 0:
            break
        current = staging.put(_stars(_stars(current, True), False), f"stars-{number}")
        now = current.agg(size).first()[0]
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    return current.select(F.col("b").alias("node"), F.col("a").alias("root"))
