"""Linear SVMs trained by gradient descent over all rows.

Rows are packed into blocks of arrays once. Each step adds up the gradients of the hinge loss of all machines in one pass
over the blocks and moves the weights on the driver, which holds one number per feature and class; a task gives back the features
it has, once. The machine has no intercept and its threshold is cleared: it gives margins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.mllib.classification import SVMModel
from pyspark.mllib.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from mailsift.session import stored

ITERATIONS = 100
STEP = 1.0
REGULARISATION = 0.01
# Entries of a block, which is a file and read by itself, and features in a row that a task gives back.
BLOCK_ENTRIES = 1 << 19
SENT = 1 << 16
_ROWS_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch"
BLOCK = "n int, ids binary, sizes binary, own binary, at binary, weights binary, counts binary, rows binary, turned binary"


def _packed(rows: DataFrame, class_ids: list[int]) -> DataFrame:
    """Rows as blocks: the features of a block, its entries by row with the places of their features (``sizes``, ``at``,
    ``weights``), and by feature with the places of their rows (``counts``, ``rows``, ``turned``)."""
    places = {c: i for i, c in enumerate(class_ids)}

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        lists = [table[c].combine_chunks() for c in ("ids", "weights")]
        sizes = lists[0].value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ids, weights = (c.flatten().to_numpy(zero_copy_only=False) for c in lists)
        distinct, at = np.unique(ids, return_inverse=True)
        order = np.argsort(at, kind="stable")
        arrays = {
            "ids": distinct.astype(np.int32),
            "sizes": sizes.astype(np.int32),
            "own": np.array([places.get(c, -1) for c in table["class_id"].to_pylist()], np.int32),
            "at": at.astype(np.int32),
            "weights": weights.astype(float),
            "counts": np.bincount(at, minlength=len(distinct)).astype(np.int32),
            "rows": np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order],
            "turned": weights[order].astype(float),
        }
        columns = [pa.array([table.num_rows], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in arrays.values()]]
        return pa.RecordBatch.from_arrays(columns, names=["n", *arrays])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            sizes = batch.column("ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            start = 0
            for row, entries in enumerate(sizes.tolist()):
                held += entries
                if held >= BLOCK_ENTRIES:
                    yield block([*parts, batch.slice(start, row + 1 - start)])
                    parts, held, start = [], 0, row + 1
            if start < batch.num_rows:
                parts.append(batch.slice(start))
        if parts:
            yield block(parts)

    entries = rows.select("class_id", F.col("features.feature_id").alias("ids"), F.col("features.weight").alias("weights"))
    # As many parts as run at once: what a step sends back grows with their number.
    width = rows.sparkSession.sparkContext.defaultParallelism
    return stored(entries.repartition(width).mapInArrow(pack, BLOCK), "descent-blocks", maxRecordsPerFile=1).coalesce(width)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of so many values in a row each."""
    sums, some = np.zeros(len(sizes)), sizes > 0
    if len(values):
        sums[some] = np.add.reduceat(values, (np.cumsum(sizes, dtype=np.int64) - sizes)[some])
    return sums


def _pull(block: dict, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of a block, and for each machine the sum of the rows that lie within its margin or on the wrong side."""
    ids, at, sizes, own, counts, rows = (
        np.frombuffer(block[c], np.int32) for c in ("ids", "at", "sizes", "own", "counts", "rows")
    )
    values, turned = np.frombuffer(block["weights"]), np.frombuffer(block["turned"])
    pulls = np.empty((len(weights), len(ids)))
    for machine, line in enumerate(weights):
        side = np.where(own == machine, 1.0, -1.0)
        margins = _sums(line[ids - 1][at] * values, sizes)
        pulls[machine] = _sums((side * (side * margins < 1))[rows] * turned, counts)
    return ids, pulls


def train(
    rows: DataFrame, class_ids: list[int], size: int, iterations: int = ITERATIONS, tolerance: float = 0.001
) -> dict[int, SVMModel]:
    """A machine per class that tells it from all others.

    ``rows`` (class_id, features), ``features`` sparse with ids from 1 to ``size``; a row whose class is null belongs
    to the others. Training ends before ``iterations`` where the weights move by less than ``tolerance``. Steps, regularisation
    and end are those of MLlib's ``SVMWithSGD`` over all rows.
    """
    session = rows.sparkSession
    context = session.sparkContext
    blocks = _packed(rows, class_ids)
    n = blocks.agg(F.sum("n")).first()[0] or 0
    weights = np.zeros((len(class_ids), size))
    moving = np.arange(len(class_ids))
    for step in range(1, iterations + 1):
        if not len(moving) or not n:
            break
        shared = context.broadcast((moving, weights[moving]))

        def pulled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            machines, current = shared.value
            total, seen = np.zeros(current.shape), np.zeros(size, bool)
            for batch in batches:
                for at in range(batch.num_rows):
                    row = {c: batch.column(c)[at].as_buffer() for c in batch.schema.names if c != "n"}
                    # Blocks count classes, a step only those that still move.
                    own = np.frombuffer(row["own"], np.int32)
                    place = np.full(int(max(own.max(initial=-1), machines.max())) + 2, -1, np.int32)
                    place[machines] = np.arange(len(machines))
                    row["own"] = place[own].tobytes()
                    ids, pulls = _pull(row, current)
                    total[:, ids - 1] += pulls
                    seen[ids - 1] = True
            found = np.flatnonzero(seen).astype(np.int32)
            for start in range(0, len(found), SENT):
                some = found[start : start + SENT]
                yield pa.RecordBatch.from_pydict({"ids": [(some + 1).tobytes()], "pulls": [total[:, some].tobytes()]})

        pull = np.zeros((len(moving), size))
        # A block is large: one at a time goes to Python.
        rows_at_once = session.conf.get(_ROWS_AT_ONCE)
        session.conf.set(_ROWS_AT_ONCE, 1)
        try:
            found = blocks.mapInArrow(pulled, "ids binary, pulls binary").toArrow().to_batches()
        finally:
            session.conf.set(_ROWS_AT_ONCE, rows_at_once)
        for part in found:
            for ids, pulls in zip(*part.columns):
                ids = np.frombuffer(ids.as_buffer(), np.int32)
                pull[:, ids - 1] += np.frombuffer(pulls.as_buffer()).reshape(-1, len(ids))
        shared.destroy()
        rate = STEP / step**0.5
        moves = np.zeros(len(moving), bool)
        for at, machine in enumerate(moving):
            before = weights[machine].copy()
            weights[machine] = before * (1 - rate * REGULARISATION) + pull[at] * (rate / n)
            moves[at] = np.linalg.norm(weights[machine] - before) >= tolerance * max(np.linalg.norm(weights[machine]), 1)
        if step > 1:
            moving = moving[moves]
    return {c: SVMModel(Vectors.dense(w), 0.0) for c, w in zip(class_ids, weights)}


def weight_tables(spark: SparkSession, models: dict[int, SVMModel]) -> tuple[DataFrame, DataFrame]:
    """(class_id, feature_id, weight) and (class_id, intercept), the form that ``linear`` scores with. Weights that
    are 0 have no row."""
    parts = []
    for class_id, model in models.items():
        weights = model.weights.toArray()
        at = np.flatnonzero(weights)
        ids = pa.array(np.full(len(at), class_id), pa.int32())
        parts.append(pa.table([ids, pa.array(at + 1, pa.int32()), pa.array(weights[at], pa.float64())],
                              names=["class_id", "feature_id", "weight"]))
    intercepts = [(int(c), float(m.intercept)) for c, m in models.items()]
    return spark.createDataFrame(pa.concat_tables(parts)), spark.createDataFrame(intercepts, "class_id int, intercept double")
