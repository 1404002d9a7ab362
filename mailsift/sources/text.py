"""Plain text corpora."""

from __future__ import annotations

from functools import reduce

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from mailsift.functions import paths as P
from mailsift.sources.files import FORMAT, WholeFiles

# Files that a task writing one folder per class has open at once, and the bytes it holds for each.
OPEN_FILES = 64
ROW_GROUP_BYTES = 8 << 20
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def read_lines(spark: SparkSession, *paths: str, recursive: bool = False) -> DataFrame:
    """(path, value): one row per line of the files below the paths."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    return reader.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), "value")


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, text): one row per whole file below ``root``, empty files included, which Spark's own file sources
    pass over. Tasks get about equal bytes."""
    spark.dataSource.register(WholeFiles)
    return spark.read.format(FORMAT).load(_uri(root))


def write_files(rows: DataFrame, root: str) -> None:
    """One file per (path, text) row below ``root``; a null text is an empty file. Two rows of one path, or
    one that is there already, are an error. Files appear when all of them are written."""
    rows.sparkSession.dataSource.register(WholeFiles)
    rows.select("path", "text").write.format(FORMAT).mode("append").save(_uri(root))


def _uri(root: str) -> str:
    return root if ":/" in root else f"file://{root}"


def read_corpus(spark: SparkSession, root: str) -> DataFrame:
    """(doc_id, class_name, text) of a corpus kept as ``<root>/<class name>/<file>``.

    File names repeat between classes, so the id is ``<class name>/<file>``.
    """
    path = F.col("path")
    depth = len(fs.FileSystem.from_uri(_uri(root))[1].rstrip("/").split("/")) + 2
    return read_files(spark, root).filter(F.size(F.split(path, "/")) == depth).select(
        F.concat_ws("/", P.directory_name(path), P.file_name(path)).alias("doc_id"),
        P.directory_name(path).alias("class_name"),
        "text",
    )


def read_clean_tokens(spark: SparkSession, *paths: str) -> DataFrame:
    """(doc_id, document, class_id, word) of cleaned messages kept as ``<document>-<class id>`` files
    with one token per line. ``doc_id`` is the whole file name, since documents of different classes
    may have one name; the class is what follows its last dash. Files are read whole, many small ones in a task:
    a scan of lines takes only a few dozen files into a task, whatever their size."""
    spark.dataSource.register(WholeFiles)
    files = [spark.read.format(FORMAT).option("required", "true").load(_uri(path)) for path in paths]
    name = P.file_name(F.col("path"))
    words = F.explode(F.filter(F.split("text", "[ \t\n\r\f]+"), lambda w: w != ""))
    return reduce(DataFrame.unionByName, files).select(
        name.alias("doc_id"),
        P.document_before_class(name).alias("document"),
        P.class_at_end_of(name).try_cast("int").alias("class_id"),
        words.alias("word"),
    )


def write_clean_tokens(tokens: DataFrame, path: str) -> None:
    """Replace ``path`` by the token table, one folder per class. A file per message would leave
    millions of tiny files. A task keeps the files of up to OPEN_FILES classes open, and so needs no sort of its
    tokens by class, which would hold them all."""
    conf = tokens.sparkSession.conf
    before = conf.get(_WRITERS)
    conf.set(_WRITERS, OPEN_FILES)
    try:
        writer = tokens.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES)
        writer.partitionBy("class_id").parquet(path)
    finally:
        conf.set(_WRITERS, before)


def read_clean_token_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Replace ``path`` by the single string column as text."""
    lines.write.mode("overwrite").text(path)


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """(word): the distinct white-space separated words of a file."""
    words = F.explode(F.split("value", "\\s+")).alias("word")
    return read_lines(spark, path).select(words).filter("word <> ''").distinct()
