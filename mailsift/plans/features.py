"""Corpus → TF-IDF → sparse vectors, end to end."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from mailsift.operators.dictionary import number_in_order
from mailsift.operators.tfidf import (
    corpus_size,
    document_frequency,
    inverse_document_frequency,
    term_frequency,
    tfidf,
    tfidf_of,
)
from mailsift.operators.tokens import by_document, clean_tokens
from mailsift.operators.vectors import sparse_vectors
from mailsift.operators.words import with_word_values
from mailsift.session import dropped, stored


class Vectors(NamedTuple):
    train: DataFrame
    test: DataFrame
    dictionary: DataFrame


def tokens_of(messages: DataFrame) -> DataFrame:
    """Clean tokens where the messages are: for counts over the whole corpus."""
    return clean_tokens(messages)


def document_tokens(messages: DataFrame) -> DataFrame:
    """Clean tokens with each document in one place: for counts per document and word."""
    return clean_tokens(by_document(messages))


def counted(messages: DataFrame, *carried: str) -> DataFrame:
    """Stored counts per document and word."""
    return stored(term_frequency(document_tokens(messages), *carried), "term-frequency")


def word_counts(messages: DataFrame, *carried: str) -> DataFrame:
    """Stored (doc_id, carried…, word, cnt). The lengths of documents are not asked for, so nothing is sorted by document."""
    tf = term_frequency(document_tokens(messages), *carried)
    return stored(tf.select("doc_id", *carried, "word", "cnt"), "word-counts")


def corpus_tfidf(messages: DataFrame) -> DataFrame:
    """(doc_id, class_id, word, weight)"""
    return tfidf_of(messages, document_tokens(messages), "class_id")


def lexicon(messages: DataFrame, tf: DataFrame | None = None) -> DataFrame:
    """(word, df, idf, feature_id): dictionary and document frequencies of a training corpus in
    one table, so that vectors need a single join on the word. ``tf``: its counts, if at hand."""
    df = document_frequency(counted(messages) if tf is None else tf)
    idf = inverse_document_frequency(df, corpus_size(messages))
    return number_in_order(idf, "word", "feature_id")


def _entries_of(tf: DataFrame, lexicon: DataFrame, frequency: str | None = None) -> DataFrame:
    """Stored (doc_id, class_id, feature_id, weight) of counts over a lexicon and its idf."""
    weight = (F.col("tf") * F.col("idf")).alias("weight")
    known = with_word_values(tf, lexicon, frequency).select("doc_id", "class_id", "feature_id", weight)
    return stored(known, "vector-entries")


def _gathered(entries: DataFrame) -> DataFrame:
    features = F.array_sort(F.collect_list(F.struct("feature_id", "weight")))
    return entries.groupBy("doc_id", "class_id").agg(features.alias("features"))


def vectors_of(tf: DataFrame, lexicon: DataFrame, frequency: str | None = None) -> DataFrame:
    """(doc_id, class_id, features) of counts over a lexicon and its idf. The entries are written before they go to their
    documents, so that the disk holds the files of one shuffle at a time."""
    return _gathered(_entries_of(tf, lexicon, frequency))


def _stored_vectors(tf: DataFrame, lexicon: DataFrame, frequency: str | None = None) -> DataFrame:
    """``vectors_of`` stored counts that nothing else reads, stored; the counts are dropped."""
    entries = _entries_of(tf, lexicon, frequency)
    dropped(tf)
    vectors = stored(_gathered(entries), "vectors")
    dropped(entries)
    return vectors


def applied_vectors(messages: DataFrame, lexicon: DataFrame, idf_from: str = "train") -> DataFrame:
    """(doc_id, class_id, features) of a corpus over the dictionary of another.

    ``idf_from="self"`` weighs with the document frequencies of ``messages`` themselves.
    """
    tf = counted(messages, "class_id")
    if idf_from == "train":
        return vectors_of(tf, lexicon)
    idf = inverse_document_frequency(document_frequency(tf), corpus_size(messages))
    return sparse_vectors(tfidf(tf, stored(idf), "df"), lexicon.select("word", "feature_id"))


def corpus_vectors(messages: DataFrame, tf: DataFrame | None = None, words: DataFrame | None = None) -> DataFrame:
    """(doc_id, class_id, features) over the corpus's own dictionary."""
    tf = counted(messages, "class_id") if tf is None else tf
    return vectors_of(tf, stored(lexicon(messages, tf)) if words is None else words, "df")


def train_and_test_vectors(train: DataFrame, test: DataFrame) -> Vectors:
    """Stored vectors of both corpora over the dictionary and idf of the training corpus."""
    tf = counted(train, "class_id")
    words = stored(lexicon(train, tf))
    vectors = _stored_vectors(tf, words, "df")
    return Vectors(vectors, _stored_vectors(counted(test, "class_id"), words), words)
