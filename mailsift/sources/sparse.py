"""Labelled sparse lines: ``<label> <id>:<weight> <id>:<weight> …``"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailsift.functions.features import as_text
from mailsift.session import shuffles_removed


def parse_line(line: Column) -> Column:
    """``STRUCT<label INT, features>`` of one line. The ids may stand in any order; they are
    sorted."""
    parts = F.split(line, " ")
    pairs = F.filter(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p != "")
    features = F.transform(
        pairs,
        lambda p: F.struct(
            F.split_part(p, F.lit(":"), F.lit(1)).cast("int").alias("feature_id"),
            F.split_part(p, F.lit(":"), F.lit(2)).cast("double").alias("weight"),
        ),
    )
    return F.struct(
        F.get(parts, 0).cast("double").cast("int").alias("label"), F.array_sort(features).alias("features")
    )


def read_sparse_lines(spark: SparkSession, path: str) -> DataFrame:
    """(label, features), ids in any order."""
    return spark.read.text(path).select(parse_line(F.col("value")).alias("v")).select("v.*")


def write_sparse_lines(vectors: DataFrame, path: str, compression: str = "none") -> None:
    """Replace ``path`` by one line per (label, features) row. Compressed lines are read back like others."""
    lines = vectors.select(as_text(F.col("label"), F.col("features")))
    with shuffles_removed(vectors.sparkSession):
        lines.write.mode("overwrite").option("compression", compression).text(path)


def read_libsvm(spark: SparkSession, path: str, size: int | None = None) -> DataFrame:
    """(label, features) with ML vectors. Without ``size`` Spark scans the data for it first."""
    reader = spark.read.format("libsvm")
    return (reader.option("numFeatures", size) if size else reader).load(path)


def write_libsvm(rows: DataFrame, path: str) -> None:
    """Replace ``path`` by (label DOUBLE, features VECTOR) rows in strict libsvm form."""
    rows.select("label", "features").write.format("libsvm").mode("overwrite").save(path)
