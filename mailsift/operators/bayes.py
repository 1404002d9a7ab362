"""Multinomial Naive Bayes over words.

Training is three aggregations. Scoring avoids one row per (token, class): with Laplace smoothing

    score(d, c) = ln prior_c + sum_w n_dw * ln((n_wc + 1) / (tokens_c + V))
                = ln prior_c - len_d * ln(tokens_c + V) + sum_{w in model of c} n_dw * ln(n_wc + 1)

so only words the model has seen with a class meet that class in a join; every other token is paid
for by the length term. ``V`` is the number of distinct words over all classes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from mailsift.operators.classes import Places, by_class, class_lists, class_sums, likeliest
from mailsift.operators.words import with_word_values
from mailsift.session import stored

# The logarithm of the smallest positive double. Below it a probability is taken as 0.
LOG_OF_ZERO = math.log(5e-324)


@dataclass(frozen=True)
class BayesModel:
    """``counts``: (class_id, word, cnt). ``classes``: (class_id, n_docs, n_tokens, vocabulary,
    log_prior, log_total) with ``log_total = ln(n_tokens + V)``, one row per class."""

    counts: DataFrame
    classes: DataFrame

    def save(self, path: str) -> None:
        self.counts.write.mode("overwrite").parquet(f"{path}/counts")
        self.classes.write.mode("overwrite").parquet(f"{path}/classes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BayesModel:
        return cls(spark.read.parquet(f"{path}/counts"), spark.read.parquet(f"{path}/classes"))


def train_counts(tokens: DataFrame) -> DataFrame:
    """(class_id, word, cnt)"""
    return tokens.groupBy("class_id", "word").agg(F.count("*").alias("cnt"))


def class_stats(counts: DataFrame) -> DataFrame:
    """(class_id, n_docs, n_tokens, vocabulary, log_prior, log_total) from (class_id, word, cnt,
    n_first)."""
    per_class = counts.groupBy("class_id").agg(
        F.sum("cnt").alias("n_tokens"), F.sum("n_first").alias("n_docs")
    )
    vocabulary = counts.agg(F.count_distinct("word").alias("v")).scalar()
    n_docs = counts.agg(F.sum("n_first").alias("n")).scalar()
    return per_class.select(
        "class_id",
        "n_docs",
        "n_tokens",
        vocabulary.alias("vocabulary"),
        F.log(F.col("n_docs") / n_docs).alias("log_prior"),
        F.log((F.col("n_tokens") + vocabulary).cast("double")).alias("log_total"),
    )


def train(tokens: DataFrame) -> BayesModel:
    """Model of (class_id, word, is_first) tokens, ``is_first`` marking one token of each document, in
    one pass. Documents without tokens do not count towards the priors. The counts are stored: priors,
    totals, vocabulary and every later scoring read them instead of the corpus."""
    first = F.sum(F.col("is_first").cast("bigint")).alias("n_first")
    counts = tokens.groupBy("class_id", "word").agg(F.count("*").alias("cnt"), first)
    counts = stored(counts, "bayes-counts")
    return BayesModel(counts.drop("n_first"), stored(class_stats(counts), "bayes-classes"))


def score_vectors(tf: DataFrame, model: BayesModel, prior: str = "documents") -> tuple[DataFrame, Places]:
    """(doc_id, sums), the scores of every document with tokens class by class, and the order of the classes.

    ``tf`` has (doc_id, word, cnt), stored. ``prior="documents"`` adds ``ln(n_docs_c / n_docs)``,
    ``prior="uniform"`` adds nothing. Words outside the vocabulary count with ``1/(tokens_c + V)``.

    The model travels as one row per word with the values of all classes.
    """
    places = Places.of(model.classes, "log_prior", "log_total")
    start, per_token = places.constants["log_prior"], places.constants["log_total"]
    if prior != "documents":
        start = np.zeros(len(start))
    rows = tf.select("doc_id", "word", F.col("cnt").alias("weight"))
    sums = class_sums(rows, model.counts, F.log1p("cnt"), "word", places, start, -per_token, F.col("cnt"))
    return sums, places


def log_scores(tf: DataFrame, model: BayesModel, prior: str = "documents") -> DataFrame:
    """(doc_id, class_id, score) for every document with tokens and every class, by ``score_vectors``."""
    return by_class(*score_vectors(tf, model, prior), "score")


def most_likely(tf: DataFrame, model: BayesModel, prior: str = "documents") -> DataFrame:
    """(doc_id, prediction) as ``predict`` gives it for ``log_scores``, without a row per class."""
    return likeliest(*score_vectors(tf, model, prior)).select("doc_id", F.col("class_id").alias("prediction"))


def linear_scores(scores: DataFrame) -> DataFrame:
    """Scores as probabilities in double arithmetic: long documents underflow to 0."""
    return scores.withColumn(
        "score", F.when(F.col("score") < LOG_OF_ZERO, 0.0).otherwise(F.exp("score"))
    )


# Products of so many probabilities cannot leave the range of doubles; longer documents go by their log scores.
PRODUCT_TOKENS = 20


def linear_products(tf: DataFrame, model: BayesModel, longest: int = PRODUCT_TOKENS) -> DataFrame:
    """(doc_id, class_id, n_tokens, score, underflow): prior times the product of the word probabilities for documents
    of at most ``longest`` tokens. Longer ones have a null score and the rule of ``linear_scores`` for ``underflow``.

    ``tf`` (doc_id, word, cnt), stored. Words that a class has not seen count with ``1/(tokens_c + V)``; only the
    others become rows of (document, class, word).
    """
    scores = log_scores(tf, model)
    lengths = tf.groupBy("doc_id").agg(F.sum("cnt").alias("n_tokens"))
    short = stored(tf.join(lengths.filter(F.col("n_tokens") <= longest), "doc_id").select("doc_id", "word", "cnt"))
    words = stored(class_lists(model.counts, "word", F.col("cnt") + 1, F.col("cnt")).drop("frequency"), "bayes-words")
    seen = with_word_values(short, words).select("doc_id", "cnt", F.inline("by_class"))
    products = seen.groupBy("doc_id", "class_id").agg(F.product(F.pow("value", "cnt")).alias("_product"))
    n_docs = model.classes.agg(F.sum("n_docs")).scalar()
    total = F.col("n_tokens") + F.col("vocabulary")
    constants = model.classes.select("class_id", (F.col("n_docs") / n_docs).alias("_prior"), (1.0 / total).alias("_unseen"))
    rows = scores.join(lengths, "doc_id").join(constants, "class_id").join(products, ["doc_id", "class_id"], "left")
    score = F.col("_prior") * F.pow("_unseen", "n_tokens") * F.coalesce("_product", F.lit(1.0))
    product = F.when(F.col("n_tokens") <= longest, score)
    gone = F.when(product.isNotNull(), product == 0).otherwise(F.col("score") < LOG_OF_ZERO)
    return rows.select("doc_id", "class_id", "n_tokens", product.alias("score"), gone.alias("underflow"))


def predict(scores: DataFrame) -> DataFrame:
    """(doc_id, prediction): the class with the highest score, the smallest id among equals."""
    best = F.max(F.struct(F.col("score"), (-F.col("class_id")).alias("rank")))
    return scores.groupBy("doc_id").agg(best.alias("best")).select(
        "doc_id", (-F.col("best.rank")).alias("prediction")
    )


def predict_linear(scores: DataFrame) -> DataFrame:
    """(doc_id, prediction) in the linear domain: null where all classes underflow. Classes are
    compared by their log scores, since small probabilities are rounded to few values."""
    best = F.max(F.struct(F.col("score"), (-F.col("class_id")).alias("rank")))
    return scores.groupBy("doc_id").agg(best.alias("best")).select(
        "doc_id", F.when(F.col("best.score") >= LOG_OF_ZERO, -F.col("best.rank")).alias("prediction")
    )


def with_empty(predictions: DataFrame, messages: DataFrame, model: BayesModel) -> DataFrame:
    """Also predict messages without any token: the class with the highest prior."""
    best = F.max(F.struct(F.col("log_prior"), (-F.col("class_id")).alias("rank")))
    fallback = model.classes.agg((-best["rank"]).alias("c")).scalar()
    return (
        messages.select("doc_id")
        .join(predictions, "doc_id", "left")
        .select("doc_id", F.coalesce("prediction", fallback).alias("prediction"))
    )


def with_labels(predictions: DataFrame, messages: DataFrame) -> DataFrame:
    """(doc_id, label, prediction)"""
    labels = messages.select("doc_id", F.col("class_id").alias("label"))
    return predictions.join(labels, "doc_id").select("doc_id", "label", "prediction")


def log_odds(counts: DataFrame) -> DataFrame:
    """(class_id, word, weight): how much likelier a word is in a class than in the corpus, for
    the (class, word) pairs seen in training. A linear one-vs-rest weight table."""
    corpus = counts.agg(F.sum("cnt").alias("n")).scalar()
    classes = counts.groupBy("class_id").agg(F.sum("cnt").alias("n"))
    totals = classes.agg(F.map_from_entries(F.collect_list(F.struct("class_id", "n")))).scalar()
    words = counts.groupBy("word").agg(
        F.sum("cnt").alias("_all"), F.collect_list(F.struct("class_id", "cnt")).alias("_classes")
    )
    odds = (F.col("cnt") / F.try_element_at(totals, F.col("class_id"))) / (F.col("_all") / corpus)
    return words.select("word", "_all", F.inline("_classes")).select(
        "class_id", "word", F.log(odds).alias("weight")
    )
