"""Feature dictionary: the distinct words, numbered 1..V in byte order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from mailsift.session import stored

# monotonically_increasing_id keeps the row number inside the partition in its lower 33 bits.
_ROW_BITS = 33


def number_in_order(rows: DataFrame, column: str, number: str) -> DataFrame:
    """Number the rows 1..n in the byte order of ``column`` without a global sort task. The
    values of ``column`` are distinct; other columns are carried along.

    The rows are range partitioned and sorted inside their partitions, so a row's number is its
    place in its own partition plus the sizes of the partitions before it. Only those sizes, one
    row per partition, meet in one place. The sorted rows are materialised first, since both
    passes must see the same range boundaries.
    """
    ordered = stored(
        rows.repartitionByRange(column)
        .sortWithinPartitions(column)
        .withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    )
    placed = ordered.select(
        *rows.columns,
        F.shiftright("_at", _ROW_BITS).alias("_part"),
        F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1).alias("_row"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        *rows.columns, (F.col("_before") + F.col("_row") + 1).cast("int").alias(number)
    )


def feature_dictionary(tokens: DataFrame, frequency: str | None = None) -> DataFrame:
    """(word, feature_id), with how many rows have the word as a column named ``frequency``, if given."""
    words = tokens.select("word")
    if frequency is not None:
        return number_in_order(words.groupBy("word").agg(F.count("*").alias(frequency)), "word", "feature_id")
    return number_in_order(words.distinct(), "word", "feature_id")
