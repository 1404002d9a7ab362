"""TF-IDF rows to sparse vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mailsift.operators.words import with_word_values, without_word_values


def sparse_vectors(tfidf: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(doc_id, carried…, features): one row per document, features sorted by id; words that are
    not in the dictionary are dropped (:func:`unmatched_features` lists them).

    The gathered list is bounded by the distinct words of one document.
    """
    carried = [c for c in tfidf.columns if c not in ("doc_id", "word", "weight")]
    matched = with_word_values(tfidf, dictionary.select("word", "feature_id"))
    features = F.array_sort(F.collect_list(F.struct("feature_id", "weight")))
    return matched.groupBy("doc_id", *carried).agg(features.alias("features"))


def unmatched_features(tfidf: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The TF-IDF rows whose word is not in the dictionary."""
    return without_word_values(tfidf, dictionary.select("word"))

