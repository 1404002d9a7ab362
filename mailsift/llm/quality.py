"""A quality classifier on document statistics.

Statistics of the text are standardised and mapped to random Fourier features, whose inner products
approximate a Gaussian kernel. Each partition of the training rows sums its part of the normal
equations; the sum is a matrix of a fixed size, solved by ridge regression. Raw scores are calibrated
by isotonic regression on labelled rows that the ridge fit has not seen.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mailsift.session import stored


FEATURES = 256
RIDGE = 1e-3
SEED = 9
# Raw scores are counted in this many bins before the isotonic fit.
BINS = 2_048
# The share of a plain logistic curve in a score, which tells documents on one isotonic step apart.
SLOPE = 0.02
THRESHOLD = 0.3
FOLDS = 5
# Of the folds to learn from, this one calibrates.
CALIBRATION = 4

STATISTICS = (
    "log_bytes", "log_words", "log_lines", "word_length", "word_length_spread", "distinct_words",
    "top_word", "repeated_next", "distinct_pairs", "upper", "digits", "spaces", "breaks", "not_ascii",
    "stops", "commas", "bangs", "bars", "signs", "other_marks", "marked_ends", "repeated_lines", "runs",
)


def statistics(text: str) -> list[float]:
    """The statistics of one whole text; a text without words has shares of 0."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    size = max(len(data), 1)
    seen = np.bincount(data, minlength=256)
    words, lines = text.split(), text.split("\n")
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = Counter(words)
    top = counts.most_common(1)[0][1] if words else 0
    pairs = list(zip(words, words[1:]))
    following = sum(a == b for a, b in pairs)

    def share(characters: str) -> float:
        return float(sum(seen[ord(c)] for c in characters)) / size

    letters = float(seen[97:123].sum() + seen[65:91].sum())
    ends = sum(not w[-1].isalnum() for w in words)
    return [
        math.log1p(len(data)), math.log1p(len(words)), math.log1p(len(lines)),
        float(lengths.mean()) if words else 0.0, float(lengths.std()) if words else 0.0,
        len(counts) / n, top / n, following / n, len(set(pairs)) / max(len(pairs), 1),
        float(seen[65:91].sum()) / max(letters, 1.0), float(seen[48:58].sum()) / size,
        share(" "), share("\n"), float(seen[128:].sum()) / size, share("."), share(","), share("!?"),
        share("|"), share("#%&*$@^~"), share("()[]{}<>=+/\\_`\"':;-"), ends / n,
        1.0 - len(set(lines)) / len(lines),
        float(np.count_nonzero(data[1:] == data[:-1])) / size,
    ]


def crc_remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def with_statistics(documents: DataFrame) -> DataFrame:
    """(doc_id, x) with the statistics of each row as an array; a null text is an empty one."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(measured, f"doc_id {kind}, x array<double>")


@dataclass(frozen=True)
class Model:
    """What scoring needs; its size does not depend on the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def mapped(self, x: np.ndarray) -> np.ndarray:
        standard = np.clip((x - self.mean) / self.scale, -8.0, 8.0)
        waves = np.cos(standard @ self.directions + self.phases) * math.sqrt(2.0 / len(self.phases))
        return np.hstack([waves, standard, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.mapped(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        stepped = np.interp(raw, self.knots, self.values)
        smooth = 1.0 / (1.0 + np.exp(-np.clip(4.0 * (raw - 0.5), -50, 50)))
        return np.clip((1.0 - SLOPE) * stepped + SLOPE * smooth, 0.0, 1.0)


def _stacked(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64).reshape(-1, len(STATISTICS))


def _normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The sums of z z' and z y over ``rows``: one matrix per partition, added up entry by entry on the
    cluster, so that the driver gets as many rows as the matrix has."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            z = model.mapped(_stacked(batch.column("x")))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            total = total + z.T @ np.hstack([z, y[:, None]])
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(list(total))], names=["i", "sums"]
            )

    size = len(model.weights)
    parts = rows.select("x", "y").mapInArrow(summed, "i int, sums array<double>")
    columns = [F.sum(F.get("sums", F.lit(j))).alias(f"s{j}") for j in range(size + 1)]
    found = np.zeros((size, size + 1))
    for row in parts.groupBy("i").agg(F.array(*columns).alias("sums")).collect():
        found[row.i] = row.sums
    return found[:, :size], found[:, size]


def isotonic(raw: np.ndarray, positive: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in rising order of ``raw``: the centre and the share of
    positives of each pool."""
    pools: list[list[float]] = []
    for r, p, n in zip(raw, positive, count):
        pools.append([r * n, p, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([a / n for a, _, n in pools]), np.array([p / n for _, p, n in pools])


def fit(measured: DataFrame, labels: DataFrame) -> Model | None:
    """A model of the rows of ``measured`` (doc_id, x) that ``labels`` marks and that are not held out.
    None if there is no such row: then every document scores 0.5."""
    known = labels.filter(F.col("quality").isNotNull()).select(
        F.col("doc_id").alias("_id"), (F.col("quality") > 0).cast("double").alias("y")
    )
    rows = measured.join(known, F.col("doc_id") == F.col("_id")).withColumn(
        "fold", crc_remainder(F.col("doc_id"), FOLDS)
    )
    rows = stored(rows.filter(F.col("fold") != 0).select("doc_id", "fold", "x", "y"), "quality-training")
    fitted, calibrating = rows.filter(F.col("fold") != CALIBRATION), rows.filter(F.col("fold") == CALIBRATION)
    moments = fitted.agg(
        F.count("*").alias("n"),
        *[F.avg(F.get("x", F.lit(i))).alias(f"m{i}") for i in range(len(STATISTICS))],
        *[F.stddev_pop(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(len(STATISTICS))],
    ).first()
    if not moments.n:
        return None
    mean = np.array([moments[f"m{i}"] for i in range(len(STATISTICS))])
    scale = np.array([moments[f"s{i}"] or 1.0 for i in range(len(STATISTICS))])
    random = np.random.default_rng(SEED)
    directions = random.normal(size=(len(STATISTICS), FEATURES)) / math.sqrt(len(STATISTICS))
    phases = random.uniform(0, 2 * math.pi, FEATURES)
    size = FEATURES + len(STATISTICS) + 1
    blank = Model(mean, scale, np.zeros(size), directions, phases, np.zeros(1), np.zeros(1))
    squares, products = _normal_equations(fitted, blank)
    weights = np.linalg.solve(squares + RIDGE * moments.n * np.eye(size), products)
    ridge = Model(mean, scale, weights, directions, phases, np.zeros(1), np.zeros(1))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(ridge.raw(_stacked(batch.column("x"))), -1.0, 2.0)
            bins = np.floor((raw + 1.0) / 3.0 * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bins), pa.array(raw), batch.column("y")], names=["bin", "raw", "y"]
            )

    bins = (
        calibrating.select("x", "y").mapInArrow(binned, "bin int, raw double, y double")
        .groupBy("bin").agg(F.avg("raw").alias("raw"), F.sum("y").alias("y"), F.count("*").alias("n"))
        .orderBy("bin").collect()
    )
    if bins:
        knots, values = isotonic(*(np.array([float(b[c]) for b in bins]) for c in ("raw", "y", "n")))
    else:
        knots, values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return Model(mean, scale, weights, directions, phases, knots, values)


def scored(measured: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) from (doc_id, x)."""

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _stacked(batch.column("x"))
            found = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    kind = measured.schema["doc_id"].dataType.simpleString()
    return measured.mapInArrow(scores, f"doc_id {kind}, score double")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``documents``.

    Only the text decides a score. Null and empty texts have the statistics of an empty text and a
    score. Labels that are null or of unknown documents are not used; a null ``doc_id`` has no label
    and is held out. Repeated rows get a row each, repeated labels count each time.
    """
    measured = stored(with_statistics(documents), "quality-statistics")
    rows = scored(measured, fit(measured, labels))
    return rows.select(
        "doc_id",
        (crc_remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def good_documents(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` that score ``threshold`` or more. Texts are scored where they are
    scanned; only the statistics of a row are compared with labels."""
    model = fit(with_statistics(documents), labels)
    names = documents.columns

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py() or "") for t in batch.column("text")], np.float64)
            x = x.reshape(-1, len(STATISTICS))
            good = model.score(x) >= threshold if model else np.full(len(x), 0.5 >= threshold)
            yield batch.filter(pa.array(good)).select(names)

    return documents.mapInArrow(kept, documents.schema)
