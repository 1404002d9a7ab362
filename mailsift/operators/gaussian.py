"""Gaussian Naive Bayes over dense vectors.

Training is one aggregation: number, mean and mean square of every (class, dimension). Variances are raised by a
small share of the largest variance of all rows, so that a constant dimension has a density.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailsift.operators.classes import Places, by_class, likeliest
from mailsift.session import stored

# The share of the largest variance that is added to every one.
SMOOTHING = 1e-9


def train(rows: DataFrame) -> DataFrame:
    """(class_id, at, n, mean, variance) of (class_id, features): one row for each class and dimension. Rows
    without class or vector do not count."""
    values = rows.filter(F.col("class_id").isNotNull()).select("class_id", F.posexplode("features").alias("at", "x"))
    x = F.col("x").cast("double")
    means = [F.avg(x).alias("mean"), F.avg(x * x).alias("square")]
    moments = stored(values.groupBy("class_id", "at").agg(F.count("x").alias("n"), *means), "gaussian-moments")
    n = F.sum("n")
    spread = F.sum(F.col("square") * F.col("n")) / n - F.pow(F.sum(F.col("mean") * F.col("n")) / n, 2)
    largest = moments.groupBy("at").agg(spread.alias("v")).agg(F.max("v")).scalar()
    variance = F.col("square") - F.col("mean") * F.col("mean") + largest * SMOOTHING
    return stored(moments.select("class_id", "at", "n", "mean", variance.alias("variance")), "gaussian-model")


def score_vectors(rows: DataFrame, model: DataFrame) -> tuple[DataFrame, Places]:
    """(doc_id, sums), the log density of every vector and class plus the log of the class's share of the rows,
    class by class. The model, classes times dimensions, goes to every task."""
    places = Places.of(model.filter(F.col("at") == 0), "n")
    table = model.orderBy("class_id", "at").toArrow()
    shape = (len(places.ids), -1) if len(places.ids) else (0, 0)
    mean, variance = (table.column(c).to_numpy().reshape(shape) for c in ("mean", "variance"))
    start = np.log(places.constants["n"] / places.constants["n"].sum()) - 0.5 * np.log(2 * math.pi * variance).sum(axis=1)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            away = [((x - m) ** 2 / v).sum(axis=1) for m, v in zip(mean, variance, strict=True)]
            sums = start - 0.5 * np.array(away).T if away else np.zeros((batch.num_rows, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(sums), pa.list_(pa.float64()))], names=["doc_id", "sums"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    vectors = rows.filter(F.col("features").isNotNull()).select("doc_id", F.col("features").cast("array<double>"))
    return vectors.mapInArrow(scored, f"doc_id {kind}, sums array<double>"), places


def log_scores(rows: DataFrame, model: DataFrame) -> DataFrame:
    """(doc_id, class_id, score) for every vector and class."""
    return by_class(*score_vectors(rows, model), "score")


def predict(rows: DataFrame, model: DataFrame) -> DataFrame:
    """(doc_id, score, prediction): the likeliest class of every vector, the smallest id among equals."""
    best = likeliest(*score_vectors(rows, model))
    return best.select("doc_id", F.col("best").alias("score"), F.col("class_id").alias("prediction"))
