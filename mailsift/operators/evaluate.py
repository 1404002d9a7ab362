"""Accuracy, confusion matrix, precision, recall and F1 of ``(label, prediction)`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def accuracy(predictions: DataFrame) -> DataFrame:
    """(n, correct, accuracy). A null prediction counts as wrong."""
    hit = F.coalesce((F.col("label") == F.col("prediction")).cast("bigint"), F.lit(0))
    return predictions.agg(F.count("*").alias("n"), F.sum(hit).alias("correct")).select(
        "n", "correct", F.try_divide("correct", "n").alias("accuracy")
    )


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """(label, prediction, n)"""
    return predictions.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def class_metrics(confusion: DataFrame) -> DataFrame:
    """(class_id, support, predicted, precision, recall, f1) for every class seen as a label or as
    a prediction. A ratio without a denominator is 0."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(
            F.col("label").alias("class_id"),
            F.col("n").alias("support"),
            F.lit(0).cast("bigint").alias("predicted"),
            hit.cast("bigint").alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class_id"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    totals = (
        confusion.select(F.inline(sides))
        .filter(F.col("class_id").isNotNull())
        .groupBy("class_id")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hits", "predicted"), zero)
    recall = F.coalesce(F.try_divide("hits", "support"), zero)
    f1 = F.coalesce(F.try_divide(2 * F.col("hits"), F.col("support") + F.col("predicted")), zero)
    return totals.select(
        "class_id",
        "support",
        "predicted",
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
    )
