"""Message corpora drawn from the given tables.

A corpus has ``doc_id``, ``class_id`` and ``text``. Every split into training and test messages uses
whole tables: the ``documents`` train and the ``pages`` are the test corpus, or the documents judged
in ``labels`` train and all others are the test corpus.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailsift.functions import paths as P
from mailsift.operators import classes as C


# Parts for testing a model on rows it was not trained on.
FOLDS = 3


class Split(NamedTuple):
    train: DataFrame
    test: DataFrame
    classes: DataFrame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, class_column: str = "lang") -> DataFrame:
    """(doc_id, class_name, text)"""
    rows = table(spark, sf_dir, "documents")
    return rows.select("doc_id", F.col(class_column).alias("class_name"), "text")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, class_name, text) with the directory of the page's address as its class."""
    address = F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "/+$", "")
    rows = table(spark, sf_dir, "pages")
    return rows.select(
        F.col("page_id").alias("doc_id"),
        P.directory_name(address).alias("class_name"),
        F.col("html").alias("text"),
    )


def classified(messages: DataFrame) -> DataFrame:
    return C.with_class_id(messages, C.class_map(messages))


def documents_and_pages(spark: SparkSession, sf_dir: str) -> Split:
    """Language classes: all documents train, all pages test."""
    train = documents(spark, sf_dir)
    classes = C.class_map(train)
    return Split(
        C.with_class_id(train, classes), C.with_class_id(pages(spark, sf_dir), classes), classes
    )


def judged_and_other(spark: SparkSession, sf_dir: str, class_column: str) -> Split:
    """Judged documents train, all other documents test."""
    messages = documents(spark, sf_dir, class_column)
    classes = C.class_map(messages)
    known = C.with_class_id(messages, classes)
    judged = table(spark, sf_dir, "labels").select("doc_id")
    return Split(
        known.join(judged, "doc_id", "left_semi"), known.join(judged, "doc_id", "left_anti"), classes
    )


def fold_of(doc_id: Column) -> Column:
    """The fold of a document, by a hash of its id that SQL knows too."""
    return F.conv(F.substring(F.md5(doc_id.cast("string")), 1, 4), 16, 10).cast("int") % FOLDS


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged documents with their quality (0, 1) as class 1, 2."""
    judged = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") + 1).alias("class_id"))
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(judged, "doc_id")
