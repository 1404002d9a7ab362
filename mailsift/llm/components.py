"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mailsift.session import stored


MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component_id) for every node of the (a, b) edges: the smallest node it is linked to.

    Two steps alternate until nothing changes. Large star: every node links its larger neighbours to
    its smallest one. Small star: every node links its smaller neighbours, and itself, to the
    smallest of them. What remains are stars around the smallest nodes, after a number of rounds that
    grows with the logarithm of the size. A step joins each edge with one minimum per node, so no
    neighbourhood is gathered; the rows of a hub meet its one row in a join that the engine can split.
    Edges are written between rounds.
    """
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = stored(pairs.filter(F.col("a") != F.col("b")).distinct(), "edges")
    state = None
    for _ in range(MAX_ROUNDS):
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # a: a node, b: a neighbour; low: the smallest of the node and its neighbours
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("node"), F.least("a", "low").alias("low")
        )
        large = both.filter(F.col("b") > F.col("a")).join(lowest, F.col("a") == F.col("node"))
        large = large.select(F.col("low").alias("a"), "b").distinct()
        # every b now has smaller neighbours a only
        lowest = large.groupBy("b").agg(F.min("a").alias("low")).select(F.col("b").alias("node"), "low")
        small = large.join(lowest, F.col("b") == F.col("node"))
        small = small.select(
            F.explode(
                F.array(
                    F.struct(F.col("low").alias("a"), F.col("a").alias("b")),
                    F.struct(F.col("low").alias("a"), F.col("b").alias("b")),
                )
            ).alias("e")
        ).select("e.a", "e.b")
        pairs = stored(small.filter(F.col("a") != F.col("b")).distinct(), "edges")
        previous, state = state, pairs.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == previous:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = pairs.select(F.col("a").alias("node"), F.col("a").alias("component_id")).distinct()
    return pairs.select(F.col("b").alias("node"), F.col("a").alias("component_id")).union(roots)
