"""Merkle manifest of a dataset: a digest for every row, one root, and a proof that ties each row to it.

Every language has a tree over its rows in the order of ``doc_id``; the trees' roots are the leaves of one
more tree. Nodes of one level are cut into runs of ``ARITY``; a run's parent is the digest of its members'
hexadecimal digests.

Trees are built and read by superblocks: ``ARITY ** HEIGHT`` neighbouring nodes of one tree, which are one
key of a shuffle, however many rows a language has. Upwards, each superblock becomes one node, until a tree is
one node. Downwards, the members of a superblock meet the siblings that its own node has further up (one small
row) in a cogroup: there the inner levels are reduced again, inner and outer siblings are joined to proofs,
and the leaves on trial are folded to a root.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from mailsift.session import shuffle_width, stored

ARITY = 8
# Levels inside a superblock: 8 ** 4 = 4,096 nodes.
HEIGHT = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_OF = 3

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# monotonically_increasing_id: the partition above this bit, the row's number inside it below.
ROW_BITS = 33

NODE = "tree string, pos long, n long, digest string"
PATH = "tree string, pos long, before array<string>, after array<string>, top string, root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(**changed: Column) -> Column:
    """The digest of a row: each field as byte count, colon and value, or a dash for null."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def numbered(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """``nodes`` with ``pos``, their place from 0 inside their ``tree``, and ``n``, its size.

    A sort by ranges deals a tree over as many tasks as it needs, equal rows too; its result is written, so that the
    places no longer depend on anything computed twice. One row per (partition, tree) is counted for the offsets.
    """
    keys = ["tree", *order]
    at = F.monotonically_increasing_id()
    spread = nodes.withColumn("_at", at).repartitionByRange(shuffle_width(nodes.sparkSession), *keys, "_at")
    placed = stored(spread.sortWithinPartitions(*keys, "_at").withColumn("_at", at), name)
    part, row = F.shiftright("_at", ROW_BITS), F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    placed = placed.withColumn("_part", part).withColumn("_row", row)
    runs = placed.groupBy("tree", "_part").agg(F.count("*").alias("_m"), F.min("_row").alias("_first"))
    # A tree lies in neighbouring partitions and has a row for each.
    whole = Window.partitionBy("tree")
    sums = F.sum("_m").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    before = runs.select(
        "tree", "_part", "_first", F.coalesce(sums, F.lit(0)).alias("_before"), F.sum("_m").over(whole).alias("n")
    )
    placed = placed.join(before, ["tree", "_part"])
    pos = (F.col("_before") + F.col("_row") - F.col("_first")).alias("pos")
    return placed.select(*nodes.columns, pos, "n")


def levels(digests: list[str], n: int, height: int) -> list[list[str]]:
    """The levels of a superblock of a tree of ``n`` nodes, from its members up to its one node."""
    rows = [digests]
    while n > 1 and len(rows) <= height:
        below = rows[-1]
        rows.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
        n = -(-n // ARITY)
    return rows


def superblock(height: int) -> Column:
    return F.floor(F.col("pos") / F.lit(ARITY**height)).cast("long").alias("block")


def reduced(nodes: DataFrame, height: int) -> DataFrame:
    """The superblocks of ``nodes`` (tree, pos, n, digest) as nodes of their trees."""

    def one(members: pd.DataFrame) -> pd.DataFrame:
        members = members.sort_values("pos")
        tree, n, block = members["tree"].iloc[0], int(members["n"].iloc[0]), int(members["block"].iloc[0])
        node = levels(members["digest"].tolist(), n, height)[-1][0]
        return pd.DataFrame({"tree": [tree], "pos": [block], "n": [-(-n // ARITY**height)], "digest": [node]})

    rows = nodes.select("tree", "pos", "n", "digest", superblock(height))
    return rows.groupBy("tree", "block").applyInPandas(one, NODE)


def climbed(nodes: DataFrame, height: int, name: str) -> list[DataFrame]:
    """The tables of nodes from ``nodes`` up to one node per tree."""
    tables = [nodes]
    while (tables[-1].agg(F.max("n")).first()[0] or 0) > 1:
        tables.append(stored(reduced(tables[-1], height), name))
    return tables


def siblings(rows: list[list[str]], at: int) -> tuple[list[str], list[str]]:
    """Of each level, the members of the node's run that stand before it and after it."""
    before, after = [], []
    for level in rows[:-1]:
        start = at - at % ARITY
        before.append("".join(level[start:at]))
        after.append("".join(level[at + 1 : start + ARITY]))
        at //= ARITY
    return before, after


def descended(nodes: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """The path of each node to the root, from that of its superblock."""

    def one(members: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
        members = members.sort_values("pos")
        above = path.iloc[0]
        rows = levels(members["digest"].tolist(), int(members["n"].iloc[0]), height)
        found = [siblings(rows, i) for i in range(len(members))]
        return pd.DataFrame({
            "tree": members["tree"], "pos": members["pos"],
            "before": [b + list(above["before"]) for b, _ in found],
            "after": [a + list(above["after"]) for _, a in found],
            "top": above["top"], "root": above["root"],
        })

    rows = nodes.select("tree", "pos", "n", "digest", superblock(height))
    return rows.groupBy("tree", "block").cogroup(outer.groupBy("tree", "pos")).applyInPandas(one, PATH)


def proven(leaves: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """Proofs of all leaves (tree, pos, n, id, digest, trial), and what ``trial`` folds to."""

    def one(members: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
        members = members.sort_values("pos")
        above = path.iloc[0]
        rows = levels(members["digest"].tolist(), int(members["n"].iloc[0]), height)
        proofs, folds = [], []
        for at, trial in enumerate(members["trial"]):
            before, after = siblings(rows, at)
            proof, node = hashlib.sha256(), trial
            for left, right in zip(before + list(above["before"]), after + list(above["after"]), strict=True):
                proof.update((left + right).encode())
                node = digest(left + node + right)
            proofs.append(proof.hexdigest())
            folds.append(node)
        return pd.DataFrame({
            "id": members["id"], "leaf": members["digest"], "subroot": above["top"], "root": above["root"],
            "proof_sha256": proofs, "folded_root": folds,
        })

    kinds = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    rows = leaves.select("tree", "pos", "n", "id", "digest", "trial", superblock(height))
    return rows.groupBy("tree", "block").cogroup(outer.groupBy("tree", "pos")).applyInPandas(one, kinds)


def manifest(documents: DataFrame, trial: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``documents``.

    ``trial`` is the leaf that is folded along each row's proof; by default that of the row as it is. A
    superblock has ``ARITY ** height`` nodes; its size changes no digest. A tree
    holds the rows of one ``lang``; null is a language of its own and the first one. Rows with equal ``doc_id`` are
    in the order of their digests, a null one comes first; any field may be null, empty or long. Further
    columns do not count. An empty table has no rows.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select(
        F.coalesce(F.concat(F.lit("+"), "lang"), F.lit("")).alias("tree"), "doc_id",
        leaf().alias("digest"), (leaf() if trial is None else trial).alias("trial"),
    )
    leaves = numbered(stored(rows, "merkle-leaves"), ["doc_id", "digest"], "merkle-sorted")
    leaves = leaves.withColumn("id", F.col("doc_id").cast("string"))
    trees = climbed(leaves, height, "merkle-nodes")
    tops = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    tops = stored(numbered(stored(tops, "merkle-tops"), ["of"], "merkle-tops-sorted"), "merkle-tops-numbered")
    forest = climbed(tops, height, "merkle-forest")

    none = F.array().cast("array<string>")
    root = F.col("digest").alias("root")
    paths = forest[-1].select("tree", "pos", none.alias("before"), none.alias("after"), F.lit("").alias("top"), root)
    for nodes in reversed(forest[:-1]):
        paths = stored(descended(nodes, paths, height), "merkle-paths")
    own = tops.select("pos", F.col("of").alias("tree"), F.col("digest").alias("top"))
    paths = own.join(paths.drop("tree", "top"), "pos")
    paths = paths.select("tree", F.lit(0).cast("long").alias("pos"), "before", "after", "top", "root")
    for nodes in reversed(trees[1:-1]):
        paths = stored(descended(nodes, paths, height), "merkle-paths")
    return proven(leaves, paths, height).select(
        F.col("id").cast(kind).alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def lower_cased(one_in: int = TAMPERED_OF) -> Column:
    """The leaf of a row whose text is lower-cased where ``one_in`` divides the checksum of its id."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % one_in == 0
    return F.when(chosen, leaf(text=F.translate("text", UPPER, LOWER))).otherwise(leaf())
