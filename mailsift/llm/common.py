"""What several operators share: reading tables, intermediate tables, ranks without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


# A word is a run of bytes other than space and the controls 0x09 to 0x0D.
WORD = "[^\\x20\\x09-\\x0D]+"
WORD_BREAKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """The number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def gapless_rank(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], spread: Column, name: str,
    extra: DataFrame | None = None, buckets: int = 256,
) -> DataFrame:
    """``df`` with ``name``: a number from 0 without gaps inside each group of ``keys``, and with the
    columns of ``extra``, a table that has one row per group.

    Rows of a group are dealt by the hash of ``spread`` into ``buckets``; buckets are numbered one
    after the other, and rows inside a bucket by ``order``. A group of any size is thus sorted by
    many tasks, and only one count per (group, bucket) meets in one place. Nothing is sampled, so a
    task that runs again gives the same numbers. Null keys are a group.
    """
    group = F.array(*[F.col(k).cast("string") for k in keys]).alias("_group")
    dealt = df.select("*", group, F.pmod(F.xxhash64(spread), F.lit(buckets)).alias("_bucket"))
    sizes = dealt.groupBy("_group", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(before), F.lit(0))
    starts = sizes.select("_group", "_bucket", start.alias("_start"))
    more = []
    if extra is not None:
        more = [c for c in extra.columns if c not in keys]
        starts = starts.join(extra.select(group, *more), "_group")
    inside = Window.partitionBy("_group", "_bucket").orderBy(*order)
    return (
        dealt.withColumn("_row", F.row_number().over(inside) - 1)
        .join(starts, ["_group", "_bucket"])
        .withColumn(name, (F.col("_start") + F.col("_row")).cast("long"))
        .select(*df.columns, *more, name)
    )


def row_hash(documents: DataFrame) -> Column:
    return F.xxhash64(*[documents[c] for c in documents.columns])


def kept_rows(documents: DataFrame, rows: DataFrame) -> DataFrame:
    """One row of ``documents`` for each ``root``: of its ``rows`` (doc_id, mark, text_hash, row_hash, root)
    the one with the smallest id (a null one is the largest), then mark and text."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "text_hash", "row_hash")
    kept = rows.groupBy("root").agg(F.min(order).alias("k"))
    kept = kept.select(F.col("k.doc_id").alias("_id"), F.col("k.text_hash").alias("_t"), F.col("k.row_hash").alias("_r"))
    same = documents["doc_id"].eqNullSafe(kept["_id"]) & (F.xxhash64(documents["text"]) == kept["_t"])
    found = documents.join(kept, same & (row_hash(documents) == kept["_r"]), "left_semi")
    # Only rows that are the same in every column are left more than once.
    return found.dropDuplicates(["doc_id", "text"])
