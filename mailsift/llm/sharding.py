"""Sharding by a hierarchical weighted hash tree.

The tree has regions, racks and shards; a key descends from the root, at every level to the child that wins a
weighted hash draw. A child's draw is an exponential clock made from the hash of (key, node), whose rate is the
weight of the child's whole subtree; the earliest clock wins, so a child wins in proportion to its weight. The
draws of a level are those of one node's children: a key costs levels times fan-out, however many shards there are.

A change of weights changes the clocks of the nodes above it only. Keys that move come into, or go out of, the
subtree whose weight changed, at every level. A new shard that opens a new region takes keys only into itself.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from mailsift.llm.common import gapless_rank

# The shape of the tree: shards in a rack, racks in a region.
SHARDS_PER_RACK = 4
RACKS_PER_REGION = 3


@dataclass(frozen=True)
class Shard:
    """A leaf: its number, its place in the tree and its weight (0: takes nothing)."""

    shard: int
    region: int
    rack: int
    weight: float = 1.0


def tree(
    n_shards: int,
    weights: Sequence[float] | None = None,
    per_rack: int = SHARDS_PER_RACK,
    racks: int = RACKS_PER_REGION,
) -> list[Shard]:
    """Shards 0 to n-1, ``per_rack`` to a rack and ``racks`` racks to a region. A shard keeps its place when the
    number grows."""
    weights = weights or [1.0] * n_shards
    per_region = per_rack * racks
    return [
        Shard(s, s // per_region, s % per_region // per_rack, float(weights[s])) for s in range(n_shards)
    ]


def clock(weight: Column, *node: Column) -> Column:
    """An exponential variable with the weight as rate, decided by the key and the node; null for weight 0."""
    bits = F.shiftrightunsigned(F.xxhash64(*node), 11)
    uniform = (bits.cast("double") + 0.5) / float(1 << 53)
    return F.when(weight > 0, -F.log(uniform) / weight)


def earliest(clocks: Sequence[Column]) -> Column:
    """The place of the earliest clock, from 0."""
    every = F.array(*clocks)
    return F.array_position(every, F.array_min(every)).cast("int") - 1


def constant(values: list, kind: str) -> Column:
    """Nested lists as one literal."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def with_shard(df: DataFrame, key: Column, shards: Sequence[Shard], name: str) -> DataFrame:
    """``df`` with the int column ``name``: the shard that ``key`` descends to. A null key is a key like any other.

    The weights of the subtrees and the numbers of the shards are constant arrays, by region, rack and place.
    """
    if not any(s.weight > 0 for s in shards):
        raise ValueError("a tree needs a shard with weight")
    racks: dict[int, dict[int, list[Shard]]] = {}
    for s in shards:
        racks.setdefault(s.region, {}).setdefault(s.rack, []).append(s)
    regions = sorted(racks)
    width = max(len(r) for r in racks.values())
    by_rack = [[racks[r][k] for k in sorted(racks[r])] for r in regions]
    most = max(len(leaves) for row in by_rack for leaves in row)

    def filled(values: list, n: int, empty) -> list:
        return values + [empty] * (n - len(values))

    def leaves_of(name: str, empty) -> list:
        rows = [[filled([getattr(s, name) for s in x], most, empty) for x in row] for row in by_rack]
        return [filled(row, width, [empty] * most) for row in rows]

    leaf_weights, numbers = leaves_of("weight", 0.0), leaves_of("shard", -1)
    rack_weights = [[sum(x) for x in row] for row in leaf_weights]
    region_ids = constant(regions, "array<int>")
    rack_ids = constant([filled(sorted(racks[r]), width, -1) for r in regions], "array<array<int>>")

    at_region = earliest([
        clock(F.lit(sum(w)), key, F.lit("region"), F.lit(r)) for r, w in zip(regions, rack_weights, strict=True)
    ])
    df = df.withColumn("_region", at_region)
    region = F.get(region_ids, F.col("_region"))
    weights = F.get(constant(rack_weights, "array<array<double>>"), F.col("_region"))
    ids = F.get(rack_ids, F.col("_region"))
    df = df.withColumn("_rack", earliest([
        clock(F.get(weights, F.lit(i)), key, F.lit("rack"), region, F.get(ids, F.lit(i))) for i in range(width)
    ]))
    weights = constant(leaf_weights, "array<array<array<double>>>")
    weights, own = (
        F.get(F.get(v, F.col("_region")), F.col("_rack"))
        for v in (weights, constant(numbers, "array<array<array<int>>>"))
    )
    at_shard = earliest([
        clock(F.get(weights, F.lit(i)), key, F.lit("shard"), F.get(own, F.lit(i))) for i in range(most)
    ])
    df = df.withColumn("_place", at_shard)
    return df.withColumn(name, F.get(own, F.col("_place")).cast("int")).drop("_region", "_rack", "_place")


def assign(
    documents: DataFrame,
    n_shards: int = 24,
    weights: Sequence[float] | None = None,
    per_rack: int = SHARDS_PER_RACK,
    racks: int = RACKS_PER_REGION,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``documents``.

    ``size`` is the text's UTF-8 length plus 8. ``slot`` numbers a shard's rows from 0 without gaps.
    ``grown_shard`` is the shard with one shard more: where that one opens a region, as after the 24 of the
    default shape, rows move only into it; else only into its region, there only into its rack, and so on. A null text counts as empty; a null ``doc_id``
    is a key of its own; repeated rows share a shard and get a slot each. Only ids, sizes and
    checksums move.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.col("doc_id")
    grown = list(weights) + [1.0] if weights else None
    rows = documents.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
    )
    rows = with_shard(rows, key, tree(n_shards, weights, per_rack, racks), "shard")
    rows = with_shard(rows, key, tree(n_shards + 1, grown, per_rack, racks), "grown_shard")
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    ranked = gapless_rank(rows, ["shard"], order, key, "slot")
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
