"""Term frequency, inverse document frequency and their product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailsift.operators.words import with_word_values
from mailsift.session import stored


def corpus_size(messages: DataFrame) -> Column:
    """The number of messages, empty ones included, as a scalar of the same plan."""
    return messages.agg(F.count("*").alias("n")).scalar()


def term_frequency(tokens: DataFrame, *carried: str) -> DataFrame:
    """(doc_id, carried…, word, cnt, doc_len, tf) with ``tf = cnt / doc_len``.

    ``carried`` names columns that depend on the document. When the tokens come from
    ``by_document`` messages, neither the count nor the length moves a row.
    """
    counts = tokens.groupBy("doc_id", *carried, "word").agg(F.count("*").alias("cnt"))
    length = F.sum("cnt").over(Window.partitionBy("doc_id"))
    return counts.withColumn("doc_len", length).withColumn("tf", F.col("cnt") / F.col("doc_len"))


def document_frequency(tf: DataFrame) -> DataFrame:
    """(word, df): documents per word."""
    return tf.groupBy("word").agg(F.count("*").alias("df"))


def inverse_document_frequency(df: DataFrame, n_docs: Column) -> DataFrame:
    """(word, df, idf) with ``idf = log10((N + 1) / (df + 1))``."""
    return df.select("word", "df", F.log10((n_docs + 1) / (F.col("df") + 1)).alias("idf"))


def tfidf(tf: DataFrame, idf: DataFrame, frequency: str | None = None) -> DataFrame:
    """``tf`` rows with ``weight = tf * idf``; words without an idf are dropped. ``frequency="df"``
    states that ``idf`` was made from these ``tf`` rows (see ``with_word_values``)."""
    carried = [c for c in tf.columns if c not in ("word", "cnt", "doc_len", "tf")]
    weight = (F.col("tf") * F.col("idf")).alias("weight")
    return with_word_values(tf, idf, frequency).select(*carried, "word", weight)


def tfidf_of(messages: DataFrame, tokens: DataFrame, *carried: str) -> DataFrame:
    """TF-IDF of a corpus against itself. Texts are split into words once; counts and document
    frequencies are stored, since the join reads them more than once."""
    tf = stored(term_frequency(tokens, *carried), "term-frequency")
    idf = inverse_document_frequency(document_frequency(tf), corpus_size(messages))
    return tfidf(tf, stored(idf, "document-frequency"), "df")
