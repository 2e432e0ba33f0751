"""Connected components of a distributed edge list, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import cut_lineage


def _state(edges: DataFrame) -> tuple:
    mix = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftrightunsigned(mix, 24)), F.bit_xor(mix)).first())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Return (node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Large-star and small-star steps alternate (Kiveris et al., 2014) until the
    edges no longer change; each round is cut with a checkpoint. Only minima
    per node are aggregated (partially, before the shuffle), so no task holds a
    node's neighbours. Loops and null ends are ignored.
    """
    edges = edges.where(F.col("a") != F.col("b"))
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut_lineage(edges)
    state = _state(edges)
    for _ in range(rounds):
        if not state[0]:
            break
        # Large star: every larger neighbour of a node is linked to the node's smallest neighbour.
        lows = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        up = edges.withColumnRenamed("b", "u").join(lows, "u", "left")
        large = up.select("a", F.coalesce("m", "u").alias("b")).distinct()
        # Small star: a node's smaller neighbours are linked to the smallest of them.
        lows = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(lows, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut_lineage(down.unionByName(lows.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _state(edges)
        if before == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
