"""Joins on words.

Words follow a power law: one word may be in a third of all rows or more. A word with more than one in
``HOT_WORDS`` of the rows is hot; there can be no more than HOT_WORDS of them, whatever the data. Rows
with a hot word get their values from a table of these words, which is broadcast if its size allows, and stay
where they are; only the other rows meet the table in a shuffle, in which no key holds more than one row in
HOT_WORDS. Where the values are too large to broadcast, the engine splits the hot keys of that join.

The rows are read twice or three times, so they should be cheap to read: a stored table of counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailsift.session import scratch_path, stored

HOT_WORDS = 10_000


def hot_words(counts: DataFrame, on: str = "word") -> DataFrame:
    """The hot words of (<on>, n) counts, at most HOT_WORDS of them."""
    total = counts.agg(F.sum("n")).scalar()
    return counts.filter(F.col("n") * HOT_WORDS > total).select(on)


def with_word_values(
    rows: DataFrame,
    table: DataFrame,
    frequency: str | None = None,
    on: str = "word",
    keep_unknown: bool = False,
) -> DataFrame:
    """Join of (doc_id, <on>, …) rows with a table that has one row per word. Rows whose word is
    not in the table are dropped, or kept with nulls.

    The rows are counted per word first. When the table was made from these rows, or from a corpus like theirs,
    ``frequency`` can name its column that says how often the word occurs, which saves that pass.
    It decides only how rows travel, never which are found.
    """
    if frequency is None:
        counts = rows.groupBy(on).agg(F.count("*").alias("n"))
    else:
        counts = table.select(on, F.col(frequency).alias("n"))
    hot = hot_words(counts, on)
    values = table.select(on, F.struct(*[c for c in table.columns if c != on]).alias("_found"))
    # The values of hot words are written first: the engine broadcasts them if the files are small enough.
    few = rows.join(stored(hot.join(values, on, "left"), "hot-words"), on)
    if not keep_unknown:
        few = few.filter(F.col("_found").isNotNull())
    many = rows.join(F.broadcast(hot), on, "left_anti")
    many = many.join(values, on, "left" if keep_unknown else "inner")
    found = [*rows.columns, "_found.*"]
    return few.select(*found).unionByName(many.select(*found))


def without_word_values(rows: DataFrame, table: DataFrame, on: str = "word") -> DataFrame:
    """The rows whose word is not in ``table``. The engine splits hot words of the rows."""
    return rows.join(table.select(on), on, "left_anti").select(*rows.columns)


class WordTables:
    """Tables kept by word: rows of equal words lie in buckets of one number, sorted, so that the tables meet without
    another shuffle however often they are joined. The rows of hot words, which would make one bucket as large as the
    word is frequent, are kept apart with an even spread.
    """

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.hot: DataFrame | None = None

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
        writer = rows.repartition(self.buckets, "word").write.bucketBy(self.buckets, "word").sortBy("word")
        writer.option("path", scratch_path(self.spark, name)).saveAsTable(table)
        return self.spark.table(table)

    def rows(self, rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """Many rows per word, kept: those of hot words, which this table decides, and the others in buckets."""
        rows = stored(rows, name)
        counts = rows.groupBy("word").agg(F.count("*").alias("n"))
        self.hot = stored(hot_words(counts), "hot-words")
        few = stored(rows.join(F.broadcast(self.hot), "word", "left_semi"), name)
        return few, self._kept(rows.join(F.broadcast(self.hot), "word", "left_anti"), name)

    def values(self, table: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """One row per word, kept: those of the hot words, and all in buckets."""
        every = self._kept(table, name)
        return stored(every.join(F.broadcast(self.hot), "word", "left_semi"), name), every

    @staticmethod
    def join(rows: tuple[DataFrame, DataFrame], values: tuple[DataFrame, DataFrame]) -> DataFrame:
        """Rows with the values of their words. The buckets are merged where they lie."""
        few = rows[0].join(values[0], "word")
        many = rows[1].join(values[1].hint("merge"), "word")
        return few.unionByName(many)
