"""Near-duplicate embeddings by an epsilon grid order join.

Vectors of length 1 with a cosine of at least ``c`` are at most ``eps = sqrt(2 - 2 c)`` apart, and no
farther apart in any projection. Vectors are projected on the leading principal directions of the
corpus, which a grid of width eps cuts into cells, and sorted by the sequence of cells. Intervals of
that sequence are the nodes of a tree with the bounding box of their projections. Starting at the
root, pairs of intervals are joined recursively: a pair whose boxes are more than eps apart is skipped
with everything below it, the others are replaced by the pairs of their parts. Pairs of leaves, blocks
of a bounded number of vectors, are compared exactly.

Links are not written out. A pair of blocks yields one row per linked vector: how many vectors it is
linked to there, and the smallest vector of its component there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mailsift.llm.components import components
from mailsift.session import stored

COSINE = 0.93
BLOCK_ROWS = 1_024
# Leading principal directions that form the grid.
GRID = 8
# Components that projections look at: fewer than all leave distances in them no larger, so no pair is lost.
LEADING = 1_024
# Parts of a node of the interval tree.
FAN = 8
# Rounding in projections must not skip a pair at the very border.
SLACK = 1e-7


def usable(embedding: Column) -> Column:
    """True for a vector that has a direction: no null, no infinity, no NaN, not all zero."""
    wrong = F.exists(embedding, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return embedding.isNotNull() & ~wrong & F.exists(embedding, lambda v: v != 0)


def _units(column: pa.Array, width: int) -> np.ndarray:
    """The first ``width`` components, or zeros behind the last, of rows as unit vectors in double precision."""
    found = np.zeros((len(column), width))
    for i, v in enumerate(column.to_pylist()):
        unit = np.array(v, np.float64)
        # Scaling first keeps squares of very large or small numbers in range.
        unit /= np.abs(unit).max()
        unit /= np.sqrt((unit * unit).sum())
        found[i, : len(unit)] = unit[:width]
    return found


def principal_directions(vectors: DataFrame, width: int, count: int) -> np.ndarray:
    """(width, count): the leading eigenvectors of the covariance of the unit vectors. Every
    partition sums its moments; they are added entry by entry on the cluster."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            u = np.hstack([_units(batch.column("embedding"), width), np.ones((batch.num_rows, 1))])
            total += u.T @ u
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width + 1), pa.int32()), pa.array(list(total))], names=["i", "sums"]
        )

    parts = vectors.select("embedding").mapInArrow(moments, "i int, sums array<double>")
    entries = parts.select("i", F.posexplode("sums").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((width + 1, width + 1))
    for row in entries.collect():
        total[row.i, row.j] = row.v
    mean = total[:width, width] / max(total[width, width], 1)
    covariance = total[:width, :width] / max(total[width, width], 1) - np.outer(mean, mean)
    _, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    return np.ascontiguousarray(directions[:, ::-1][:, :count])


def _boxes(prefix: str, count: int) -> list[str]:
    return [f"{prefix}{k}" for k in range(count)]


def blocks_in_grid_order(vectors: DataFrame, width: int, directions: np.ndarray, eps: float) -> DataFrame:
    """(part, n_rows, lo…, hi…, classes, copies, vectors, place): intervals of the sorted vectors of one
    part (label and length) with their boxes. ``place`` rises along the sequence."""
    count = directions.shape[1]

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _units(batch.column("embedding"), width) @ directions
            cells = np.floor(at / eps).astype(np.int32)
            yield batch.append_column("at", pa.array(list(at), pa.list_(pa.float64()))).append_column(
                "cell", pa.array(list(cells), pa.list_(pa.int32()))
            )

    fields = "part string, class long, copies long, embedding array<float>"
    placed = vectors.select("part", "class", "copies", "embedding").mapInArrow(
        projected, f"{fields}, at array<double>, cell array<int>"
    )
    spark = vectors.sparkSession
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(shuffles, "part", "cell", "class").sortWithinPartitions(
        "part", "cell", "class"
    )
    schema = ", ".join(
        ["part string", "n_rows int", *[f"{c} double" for c in _boxes("lo", count) + _boxes("hi", count)],
         "classes binary", "copies binary", "vectors binary"]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []

        def block() -> pa.RecordBatch:
            at = np.array([r["at"] for r in rows])
            lo, hi = at.min(axis=0), at.max(axis=0)
            # One part has vectors of one length.
            vectors = np.array([r["embedding"] for r in rows], np.float32)
            made = {"part": rows[0]["part"], "n_rows": len(rows)}
            made |= {f"lo{k}": lo[k] for k in range(count)} | {f"hi{k}": hi[k] for k in range(count)}
            made |= {
                "classes": np.array([r["class"] for r in rows], "<i8").tobytes(),
                "copies": np.array([r["copies"] for r in rows], "<i8").tobytes(),
                "vectors": vectors.tobytes(),
            }
            rows.clear()
            return pa.RecordBatch.from_pylist([made], block_schema)

        for batch in batches:
            for row in batch.to_pylist():
                if rows and (len(rows) == BLOCK_ROWS or rows[0]["part"] != row["part"]):
                    yield block()
                rows.append(row)
        if rows:
            yield block()

    block_schema = pa.schema(
        [("part", pa.string()), ("n_rows", pa.int32())]
        + [(c, pa.float64()) for c in _boxes("lo", count) + _boxes("hi", count)]
        + [("classes", pa.binary()), ("copies", pa.binary()), ("vectors", pa.binary())]
    )
    made = ordered.mapInArrow(cut, schema)
    return stored(made.withColumn("place", F.monotonically_increasing_id()), "grid-blocks")


def close_pairs(boxes: DataFrame, count: int, eps: float) -> DataFrame:
    """(part, a, b), a <= b: the blocks that may hold vectors within ``eps``, by recursion over the
    interval tree. ``boxes``: (part, block, lo…, hi…), blocks numbered from 0 in each part."""
    lows, highs = _boxes("lo", count), _boxes("hi", count)
    most = boxes.agg(F.max("block")).first()[0]
    levels = 0
    while most is not None and FAN**levels <= most:
        levels += 1
    pairs = boxes.select("part").distinct().select(
        "part", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")
    )
    children = F.sequence(F.lit(0), F.lit(FAN - 1))
    for level in reversed(range(levels)):
        nodes = boxes.groupBy("part", F.floor(F.col("block") / FAN**level).cast("long").alias("node")).agg(
            *[F.min(c).alias(c) for c in lows], *[F.max(c).alias(c) for c in highs]
        )
        parts = pairs.select("part", (F.col("a") * FAN).alias("a"), (F.col("b") * FAN).alias("b"))
        parts = parts.withColumn("_i", F.explode(children)).withColumn("_j", F.explode(children)).select(
            "part", (F.col("a") + F.col("_i")).alias("a"), (F.col("b") + F.col("_j")).alias("b")
        ).filter(F.col("a") <= F.col("b"))
        left = nodes.select("part", F.col("node").alias("a"), *[F.col(c).alias(f"a_{c}") for c in lows + highs])
        right = nodes.select("part", F.col("node").alias("b"), *[F.col(c).alias(f"b_{c}") for c in lows + highs])
        gap = sum(
            (
                F.pow(
                    F.greatest(
                        F.lit(0.0),
                        F.col(f"b_{lo}") - F.col(f"a_{hi}"),
                        F.col(f"a_{lo}") - F.col(f"b_{hi}"),
                    ),
                    2,
                )
                for lo, hi in zip(lows, highs)
            ),
            F.lit(0.0),
        )
        pairs = parts.join(left, ["part", "a"]).join(right, ["part", "b"]).filter(gap <= (eps + SLACK) ** 2)
        pairs = stored(pairs.select("part", "a", "b"), "grid-pairs")
    return pairs


def _local_roots(linked: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest class each row and column of ``linked`` reaches inside it."""
    far = np.iinfo(np.int64).max
    while True:
        a_next = np.minimum(a, np.where(linked, b[None, :], far).min(axis=1, initial=far))
        b_next = np.minimum(b, np.where(linked, a_next[:, None], far).min(axis=0, initial=far))
        if (a_next == a).all() and (b_next == b).all():
            return a, b
        a, b = a_next, b_next


def _compared(cosine: float):
    """A task that compares pairs of blocks and yields (class, n, root) for linked vectors."""

    def read(row: dict, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row[f"{side}_n"] = len(row[f"{side}_classes"]) // 8
        v = np.frombuffer(row[f"{side}_vectors"], np.float32).reshape(row[f"{side}_n"], -1).astype(np.float64)
        v /= np.abs(v).max(axis=1, keepdims=True)
        v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
        return v, np.frombuffer(row[f"{side}_classes"], "<i8"), np.frombuffer(row[f"{side}_copies"], "<i8")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                (u, a, n_a), (v, b, n_b) = read(row, "a"), read(row, "b")
                linked = u @ v.T >= cosine
                same = row["a"] == row["b"]
                if same:
                    linked |= linked.T
                    np.fill_diagonal(linked, False)
                if not linked.any():
                    continue
                root_a, root_b = _local_roots(linked, a, b)
                sides = [(a, linked @ n_b, root_a)] if same else [
                    (a, linked @ n_b, root_a), (b, n_a @ linked, root_b)
                ]
                for classes, n, roots in sides:
                    some = n > 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(classes[some]), pa.array(n[some]), pa.array(roots[some])],
                        names=["class", "n", "root"],
                    )

    return compare


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``embeddings``.

    Only vectors with one non-null label and of one length are compared. Vectors that are null, zero or
    hold null or non-finite components, and rows without label, link with nothing: n_links 0 and a
    component of their own. Equal vectors are one class, compared once; each of its rows counts.
    ``component_id`` is the smallest ``vec_id`` that links reach; a null one counts only where all are.
    """
    if not 0 < cosine < 1:
        raise ValueError("cosine must lie between 0 and 1")
    eps = math.sqrt(2 - 2 * cosine)
    vector = F.col("embedding").cast("array<float>")
    rows = embeddings.select("vec_id", "label", vector.alias("embedding"))
    part = F.concat_ws(":", F.col("label").cast("string"), F.size("embedding").cast("string"))
    rows = rows.withColumn("part", F.when(F.col("label").isNotNull() & usable(F.col("embedding")), part))
    good = rows.filter(F.col("part").isNotNull())
    classes = good.groupBy("part", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "vector-classes")
    alone = rows.filter(F.col("part").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
        F.lit(True).alias("kept"),
    )
    width = classes.agg(F.max(F.size("embedding"))).first()[0]
    if width is None:
        return alone
    width = min(width, LEADING)
    directions = principal_directions(classes, width, min(GRID, width))
    count = directions.shape[1]
    blocks = blocks_in_grid_order(classes, width, directions, eps)
    lows_highs = _boxes("lo", count) + _boxes("hi", count)
    boxes = blocks.select("part", "place", *lows_highs)
    in_part = Window.partitionBy("part").orderBy("place")
    boxes = stored(boxes.withColumn("block", F.row_number().over(in_part).cast("long") - 1), "grid-boxes")
    pairs = close_pairs(boxes, count, eps)
    numbered = boxes.select("part", "block", "place")
    content = blocks.select("place", "classes", "copies", "vectors").join(numbered, "place")

    def side(name: str) -> DataFrame:
        return content.select(
            "part", F.col("block").alias(name),
            *[F.col(c).alias(f"{name}_{c}") for c in ("classes", "copies", "vectors")],
        )

    joined = pairs.join(side("a"), ["part", "a"]).join(side("b"), ["part", "b"])
    found = stored(
        joined.mapInArrow(_compared(cosine), "class long, n long, root long"), "vector-links"
    )
    linked = found.groupBy("class").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    roots = stored(roots, "vector-components").withColumnRenamed("node", "class")
    named = (
        classes.join(linked, "class", "left")
        .join(roots.withColumnRenamed("component_id", "_root"), "class", "left")
        .withColumn("_root", F.coalesce("_root", "class"))
    )
    smallest = named.groupBy("_root").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "_root").select(
        "part", "embedding", "component_id",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
    )
    together = good.join(named, ["part", "embedding"]).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
    return together.unionByName(alone)
