"""One query per operator over the given tables. Each takes (spark, sf_dir) and returns a
DataFrame; numbers that depend on the order of floating point sums are rounded."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayesModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailsift.functions import paths as P, text as T
from mailsift.functions.features import as_ml_vector
from mailsift.operators import bayes, classes as C, descent, evaluate, forest, gaussian, knn, linear, ml, tokens as K, word_vectors
from mailsift.operators.dictionary import feature_dictionary
from mailsift.operators.tfidf import (
    corpus_size,
    document_frequency,
    inverse_document_frequency,
    term_frequency,
)
from mailsift.operators.vectors import unmatched_features as unmatched
from mailsift.operators.words import WordTables, with_word_values
from mailsift.plans import corpora, features as V
from mailsift.session import dropped, scratch_path, shuffle_width, stored
from mailsift.sources import sparse, tables, text as text_source

# Words of documents that meet their vectors at once.
WORDS_AT_ONCE = 1 << 20

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under the name of its function."""
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


def _by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.classified(corpora.documents(spark, sf_dir, "lang"))


def _by_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.documents_and_pages(spark, sf_dir).test


def _by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.classified(corpora.documents(spark, sf_dir, "source"))


def _vector_text(features: Column) -> Column:
    """Features as ``id:weight`` pairs, the weight in whole billionths."""
    return F.concat_ws(
        " ",
        F.transform(
            features,
            lambda f: F.concat(
                f["feature_id"].cast("string"),
                F.lit(":"),
                F.round(f["weight"] * 1e9).cast("bigint").cast("string"),
            ),
        ),
    )


# --- text ---------------------------------------------------------------------------------------


@query
def header_filter(spark, sf_dir):
    return K.kept_lines(corpora.table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def clean_tokens(spark, sf_dir):
    return V.tokens_of(_by_lang(spark, sf_dir)).select("doc_id", "class_id", "pos", "word")


@query
def custom_stop_words(spark, sf_dir):
    """Stop words read from a file of words: the texts of ``benchmark`` serve as the list."""
    path = scratch_path(spark, "stop-words")
    text_source.write_lines(corpora.table(spark, sf_dir, "benchmark").select("text"), path)
    stop_words = text_source.read_stop_words(spark, path)
    messages = corpora.table(spark, sf_dir, "conversations").select(
        F.concat_ws(".", "conv_id", "turn").alias("doc_id"), "text"
    )
    return K.clean_tokens(messages, stop_words).select("doc_id", "pos", "word")


@query
def doc_token_count(spark, sf_dir):
    return K.token_counts(corpora.table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def regex_tokens(spark, sf_dir):
    messages = corpora.table(spark, sf_dir, "documents").select("doc_id", "text")
    return K.split_tokens(messages, T.regex_tokens)


@query
def whitespace_tokens(spark, sf_dir):
    messages = corpora.table(spark, sf_dir, "documents").select("doc_id", "text")
    return K.split_tokens(messages, T.whitespace_tokens)


@query
def newline_tokens(spark, sf_dir):
    messages = corpora.table(spark, sf_dir, "documents").select("doc_id", "text")
    return K.split_tokens(messages, T.newline_tokens)


@query
def word_count(spark, sf_dir):
    documents = corpora.table(spark, sf_dir, "documents").select("text")
    return K.word_count(documents.select(F.explode(T.lines(F.col("text"))).alias("value")))


@query
def top_words(spark, sf_dir):
    return word_count(spark, sf_dir).limit(20)


@query
def cleaning_counters(spark, sf_dir):
    """What the cleaning of the documents meets, counted while their clean texts are written."""
    messages = corpora.table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned, counters = K.counted_clean_text(messages)
    stored(cleaned, "clean-text")
    return spark.createDataFrame(list(counters.get.items()), "counter string, n bigint")


# --- paths and classes ----------------------------------------------------------------------------


@query
def path_names(spark, sf_dir):
    """Name parts of ``/mail/<lang>/<doc_id>-<source>-<class id>`` paths."""
    messages = corpora.table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", F.col("lang").alias("class_name")
    )
    classes = C.class_map(messages)
    name = F.concat_ws("-", F.col("doc_id").cast("string"), "source")
    path = F.concat_ws("/", F.lit("/mail"), "lang", P.clean_name(name, F.col("class_id")))
    paths = C.with_class_id(messages, classes).select("doc_id", path.alias("path"))
    file_name = P.file_name(F.col("path"))
    return paths.select(
        "path",
        file_name.alias("file_name"),
        P.directory_name(F.col("path")).alias("directory"),
        P.document_of(file_name).alias("document"),
        P.class_of(file_name).alias("second_part"),
        P.class_at_end_of(file_name).alias("last_part"),
    )


@query
def class_map(spark, sf_dir):
    return C.class_map(corpora.documents(spark, sf_dir, "source"))


@query
def class_lookup(spark, sf_dir):
    """Pages looked up in the language classes of the documents."""
    classes = C.class_map(corpora.documents(spark, sf_dir, "lang"))
    pages = C.with_class_id(corpora.pages(spark, sf_dir), classes)
    return pages.select("doc_id", "class_id", P.clean_name(F.col("doc_id").cast("string"), F.col("class_id")).alias("name"))


@query
def class_doc_counts(spark, sf_dir):
    return C.class_doc_counts(_by_source(spark, sf_dir), F.size(K.kept_words(F.col("text"))))


# --- features -------------------------------------------------------------------------------------


@query
def feature_dictionary_query(spark, sf_dir):
    return feature_dictionary(V.tokens_of(_by_lang(spark, sf_dir)))


@query
def term_frequency_query(spark, sf_dir):
    tf = term_frequency(V.document_tokens(_by_lang(spark, sf_dir)))
    return tf.select("doc_id", "word", "cnt", "doc_len", F.round("tf", 9).alias("tf"))


@query
def document_frequency_query(spark, sf_dir):
    messages = _by_lang(spark, sf_dir)
    df = document_frequency(term_frequency(V.document_tokens(messages)))
    idf = inverse_document_frequency(df, corpus_size(messages))
    return idf.select("word", "df", F.round("idf", 9).alias("idf"))


@query
def tfidf(spark, sf_dir):
    weights = V.corpus_tfidf(_by_lang(spark, sf_dir))
    return weights.select("doc_id", "class_id", "word", F.round("weight", 9).alias("weight"))


@query
def sparse_vectors(spark, sf_dir):
    vectors = V.corpus_vectors(_by_lang(spark, sf_dir))
    return vectors.select(
        "doc_id",
        F.col("class_id").alias("label"),
        F.size("features").alias("n_features"),
        _vector_text(F.col("features")).alias("features"),
    )


@query
def bucketed_tfidf(spark, sf_dir):
    """Weights and feature ids from counts and a lexicon that are both kept by word."""
    messages = _by_lang(spark, sf_dir)
    tf = V.counted(messages, "class_id")
    kept = WordTables(spark, shuffle_width(spark))
    rows = kept.rows(tf.select("doc_id", "class_id", "word", "tf"), "word-counts")
    values = kept.values(V.lexicon(messages, tf).select("word", "idf", "feature_id"), "word-values")
    weight = F.round(F.col("tf") * F.col("idf"), 9).alias("weight")
    return kept.join(rows, values).select("doc_id", "class_id", "word", "feature_id", weight)


@query
def applied_vectors(spark, sf_dir):
    """Pages over the dictionary and idf of the documents."""
    split = corpora.documents_and_pages(spark, sf_dir)
    vectors = V.applied_vectors(split.test, V.lexicon(split.train))
    return vectors.select(
        "doc_id",
        F.col("class_id").alias("label"),
        F.size("features").alias("n_features"),
        _vector_text(F.col("features")).alias("features"),
    )


@query
def unmatched_features(spark, sf_dir):
    """TF-IDF rows of the pages whose word the documents never use."""
    split = corpora.documents_and_pages(spark, sf_dir)
    dictionary = feature_dictionary(V.tokens_of(split.train))
    rejects = unmatched(V.corpus_tfidf(split.test), dictionary)
    return rejects.select("doc_id", "class_id", "word", F.round("weight", 9).alias("weight"))


# --- Naive Bayes ----------------------------------------------------------------------------------


@query
def nb_train_counts(spark, sf_dir):
    return bayes.train_counts(V.tokens_of(_by_source(spark, sf_dir)))


@query
def nb_class_stats(spark, sf_dir):
    model = bayes.train(K.marked_tokens(_by_source(spark, sf_dir)))
    return model.classes.select(
        "class_id",
        "n_docs",
        "n_tokens",
        "vocabulary",
        F.round("log_prior", 9).alias("log_prior"),
        F.round("log_total", 9).alias("log_total"),
    )


def _bayes_scores(split: corpora.Split, prior: str = "documents") -> DataFrame:
    model = bayes.train(K.marked_tokens(split.train))
    return bayes.log_scores(V.counted(split.test), model, prior)


def _bayes_predictions(split: corpora.Split, prior: str = "documents") -> DataFrame:
    model = bayes.train(K.marked_tokens(split.train))
    return bayes.with_labels(bayes.most_likely(V.counted(split.test), model, prior), split.test)


def _source_predictions(spark, sf_dir) -> DataFrame:
    return _bayes_predictions(corpora.judged_and_other(spark, sf_dir, "source"))


def _quality_predictions(spark, sf_dir) -> DataFrame:
    """The judged documents in folds, each classified by a model trained on the others."""
    judged = corpora.quality(spark, sf_dir).withColumn("fold", corpora.fold_of(F.col("doc_id")))
    classes = judged.select("class_id").distinct()
    found = [
        _bayes_predictions(
            corpora.Split(
                judged.filter(F.col("fold") != fold).drop("fold"),
                judged.filter(F.col("fold") == fold).drop("fold"),
                classes,
            )
        )
        for fold in range(corpora.FOLDS)
    ]
    return reduce(DataFrame.unionByName, found)


@query
def nb_log_scores(spark, sf_dir):
    scores = _bayes_scores(corpora.documents_and_pages(spark, sf_dir))
    return scores.select("doc_id", "class_id", F.round("score", 3).alias("score"))


@query
def nb_predict(spark, sf_dir):
    return _source_predictions(spark, sf_dir)


@query
def nb_predict_pages(spark, sf_dir):
    return _bayes_predictions(corpora.documents_and_pages(spark, sf_dir))


@query
def nb_predict_empty(spark, sf_dir):
    """As ``nb_predict``, messages without any token included."""
    split = corpora.judged_and_other(spark, sf_dir, "source")
    model = bayes.train(K.marked_tokens(split.train))
    found = bayes.most_likely(V.counted(split.test), model)
    return bayes.with_labels(bayes.with_empty(found, split.test, model), split.test)


@query
def nb_accuracy(spark, sf_dir):
    result = evaluate.accuracy(_source_predictions(spark, sf_dir))
    return result.withColumn("accuracy", F.round("accuracy", 9))


@query
def nb_uniform_prior(spark, sf_dir):
    return _bayes_predictions(corpora.judged_and_other(spark, sf_dir, "source"), prior="uniform")


@query
def nb_linear_underflow(spark, sf_dir):
    split = corpora.documents_and_pages(spark, sf_dir)
    return bayes.with_labels(bayes.predict_linear(_bayes_scores(split)), split.test)


# --- evaluation -----------------------------------------------------------------------------------


@query
def nb_linear_product(spark, sf_dir):
    """Products of probabilities for short documents, and where those of any length would be 0."""
    split = corpora.judged_and_other(spark, sf_dir, "source")
    model = bayes.train(K.marked_tokens(split.train))
    found = bayes.linear_products(V.counted(split.test), model)
    return found.withColumn("score", F.round(F.log10("score"), 6)).withColumnRenamed("score", "log10_score")


def _rounded_metrics(confusion: DataFrame) -> DataFrame:
    return evaluate.class_metrics(confusion).select(
        "class_id",
        "support",
        "predicted",
        *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")],
    )


@query
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(_source_predictions(spark, sf_dir))


@query
def class_metrics(spark, sf_dir):
    return _rounded_metrics(evaluate.confusion_matrix(_source_predictions(spark, sf_dir)))


@query
def class_metrics_quality(spark, sf_dir):
    return _rounded_metrics(evaluate.confusion_matrix(_quality_predictions(spark, sf_dir)))


@query
def ml_evaluator(spark, sf_dir):
    """The evaluator's figures for the predictions of ``nb_predict``."""
    rows = stored(
        _source_predictions(spark, sf_dir).select(
            (F.col("label") - 1).cast("double").alias("label"),
            (F.col("prediction") - 1).cast("double").alias("prediction"),
        )
    )
    names = ["accuracy", "weightedPrecision", "weightedRecall", "f1"]
    figures = [
        (name, round(MulticlassClassificationEvaluator(metricName=name).evaluate(rows), 9))
        for name in names
    ]
    return spark.createDataFrame(figures, "metric string, value double")


# --- nearest neighbours -----------------------------------------------------------------------------


def _sparse_neighbours(spark, sf_dir) -> DataFrame:
    split = corpora.judged_and_other(spark, sf_dir, "lang")
    vectors = V.train_and_test_vectors(split.train, split.test)
    train = vectors.train.withColumnsRenamed({"doc_id": "train_id", "class_id": "label"})
    test = vectors.test.select(F.col("doc_id").alias("query_id"), "features")
    return knn.nearest(test, train, spent=(vectors.train, vectors.test))


def _judged_embeddings(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Vectors that ``labels`` judges, and the others."""
    rows = corpora.table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("features")
    )
    judged = corpora.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("vec_id"))
    train = rows.join(judged, "vec_id", "left_semi").withColumnRenamed("vec_id", "train_id")
    return train, rows.join(judged, "vec_id", "left_anti").withColumnRenamed("vec_id", "query_id")


def _dense_neighbours(spark, sf_dir) -> DataFrame:
    train, test = _judged_embeddings(spark, sf_dir)
    return knn.nearest(test.select("query_id", "features"), train, non_negative=False, dense=True)


@query
def knn_sparse_neighbours(spark, sf_dir):
    return _sparse_neighbours(spark, sf_dir)


@query
def knn_sparse_predict(spark, sf_dir):
    return knn.vote(_sparse_neighbours(spark, sf_dir))


@query
def knn_dense_neighbours(spark, sf_dir):
    return _dense_neighbours(spark, sf_dir)


@query
def knn_dense_predict(spark, sf_dir):
    return knn.vote(_dense_neighbours(spark, sf_dir))


# --- linear models ----------------------------------------------------------------------------------


@query
def ovr_score(spark, sf_dir):
    """Pages scored by the log-odds of their words in the documents of each language."""
    split = corpora.documents_and_pages(spark, sf_dir)
    model = bayes.train(K.marked_tokens(split.train))
    values = V.counted(split.test).select("doc_id", "word", F.col("tf").alias("value"))
    intercepts = model.classes.select("class_id", F.col("log_prior").alias("intercept"))
    scored = linear.largest(values, bayes.log_odds(model.counts), intercepts, "word")
    return scored.select("doc_id", F.round("margin", 6).alias("margin"), "prediction")


# --- Spark ML estimators ----------------------------------------------------------------------------


def _hashed(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Hashed TF-IDF of both corpora; the training features are materialised for the solvers. Training texts are
    cleaned and hashed once, where they are read: the join with the few classes, which leaves no more tasks than
    classes, carries the counts."""
    documents = corpora.documents(spark, sf_dir)
    classes = C.class_map(documents)

    def counted(messages: DataFrame) -> DataFrame:
        counts = ml.hashed_counts(K.clean_text(messages)).select("doc_id", "class_name", "rawFeatures")
        return ml.labelled(C.with_class_id(counts, classes))

    counts = stored(counted(documents).select("doc_id", "label", "rawFeatures"), "hashed-counts")
    idf = ml.hashing_tfidf().getStages()[-1].fit(counts)
    hashed = idf.transform(counts).select("doc_id", "label", "features")
    # Solvers pass over the rows many times: few partitions of the advisory size, not one per core.
    return stored(hashed.hint("rebalance")), idf.transform(counted(corpora.pages(spark, sf_dir)))


def _predictions(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "label", "prediction")


@query
def hashing_tfidf_nb(spark, sf_dir):
    train, test = _hashed(spark, sf_dir)
    return _predictions(ml.naive_bayes().fit(train).transform(test))


@query
def svm_ovr(spark, sf_dir):
    """One linear SVM per language on the hashed weights; predictions are class ids, 0 for none."""
    train, test = _hashed(spark, sf_dir)
    model = ml.without_summaries(spark, ml.one_vs_rest_svm().fit(train))
    return ml.predict_one_vs_rest(model, test).select(
        "doc_id", F.col("class_id").alias("label"), "prediction"
    )


@query
def hashed_counts(spark, sf_dir):
    """Every word of a text counts in the bucket that it has as a text of one word."""
    pages = ml.labelled(K.clean_text(_by_page(spark, sf_dir)))
    words = pages.select("doc_id", F.explode(T.newline_tokens(F.col("text"))).alias("word"))
    words = stored(words.groupBy("doc_id", "word").agg(F.count("*").alias("n")))
    bucketed = with_word_values(words, stored(ml.word_buckets(words)))
    wanted = bucketed.groupBy("doc_id", "bucket").agg(F.sum("n").cast("double").alias("n"))
    wanted = wanted.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("wanted"))
    counted = ml.hashed_counts(pages).select("doc_id", ml.entries(F.col("rawFeatures")).alias("found"))
    both = counted.join(wanted, "doc_id", "left")
    none = F.array().cast("array<struct<bucket:int,n:double>>")
    return both.select("doc_id", (F.col("found") == F.coalesce("wanted", none)).alias("agrees"))


def _dictionary_vectors(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Word counts of both corpora as ML vectors over the dictionary of the documents."""
    split = corpora.documents_and_pages(spark, sf_dir)
    train, test = (V.word_counts(messages, "class_id") for messages in (split.train, split.test))
    words = stored(feature_dictionary(train.select("word"), "n"))
    size = words.agg(F.max("feature_id")).scalar()

    def vectors(tf: DataFrame, table: DataFrame, frequency: str | None = None) -> DataFrame:
        known = with_word_values(tf, table, frequency)
        entry = F.struct("feature_id", F.col("cnt").cast("double").alias("weight"))
        rows = known.groupBy("doc_id", "class_id").agg(F.array_sort(F.collect_list(entry)).alias("features"))
        features = as_ml_vector(F.col("features"), size).alias("rawFeatures")
        return stored(ml.labelled(rows.select("doc_id", "class_id", features)))

    return vectors(train, words, "n"), vectors(test, words.drop("n"))


@query
def ml_idf_nb(spark, sf_dir):
    """ML inverse document frequencies and ML Naive Bayes as one pipeline over dictionary vectors."""
    train, test = _dictionary_vectors(spark, sf_dir)
    found = ml.idf_naive_bayes().fit(train).transform(test)
    return found.select("doc_id", "class_id", (F.col("prediction") + 1).cast("int").alias("prediction"))


@query
def svm_margins(spark, sf_dir):
    """Margins of each class's SVM, trained on its binarised label, against those of its weights as a
    table."""
    train, test = _hashed(spark, sf_dir)
    model = ml.without_summaries(spark, ml.one_vs_rest_svm().fit(train))
    binary = linear.binarise(train.withColumn("label", F.col("label") + 1), 1)
    first = ml.linear_svm().fit(binary)
    weights, intercepts = ml.weight_table(spark, model.models)
    values = test.select("doc_id", F.inline(ml.entries(F.col("features")))).withColumnsRenamed({"n": "value"})
    margins = linear.margins(stored(values), weights, intercepts, "bucket").groupBy("doc_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("class_id", "margin"))), lambda m: m["margin"]).alias("wanted")
    )
    raw = model.transform(test).select("doc_id", vector_to_array("rawPrediction").alias("found"))
    both = raw.join(margins, "doc_id", "left")
    own = ml.same_weights(first, model.models[0])
    near = F.forall(F.arrays_zip("found", "wanted"), lambda m: F.abs(m["found"] - m["wanted"]) < 1e-6)
    return both.select("doc_id", (F.coalesce(near, F.col("wanted").isNull()) & F.lit(own)).alias("agrees"))


def _words(messages: DataFrame) -> DataFrame:
    return ml.labelled(K.clean_text(messages)).select(
        "doc_id", "label", T.newline_tokens(F.col("text")).alias("words")
    )


def _word_vectors(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    split = corpora.documents_and_pages(spark, sf_dir)
    train, test = stored(_words(split.train)), stored(_words(split.test))
    model = word_vectors.train(train)
    found = stored(model.transform(train, ["doc_id", "label"])), stored(model.transform(test, ["doc_id", "label"]))
    dropped(train, test)
    return found


@query
def w2v_features(spark, sf_dir):
    _, test = _word_vectors(spark, sf_dir)
    path = scratch_path(spark, "word-vectors")
    tables.write_features(test.select("doc_id", "label", "features"), path)
    saved = tables.read_features(spark, path)
    values = vector_to_array("features")
    return saved.select("doc_id", "label", F.size(values).alias("size"))


@query
def w2v_means(spark, sf_dir):
    """A document vector is the mean of its word vectors, words the training never saw left out of
    the sum; the zero vector for none."""
    split = corpora.documents_and_pages(spark, sf_dir)
    train, test = stored(_words(split.train)), stored(_words(split.test))
    model = word_vectors.train(train)
    size = model.size
    words = test.select("doc_id", F.explode("words").alias("word")).groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    words = stored(words, "document-words")
    needed = stored(model.table.join(words.select("word").distinct(), "word", "left_semi"), "needed-vectors")
    # Some documents at a time: a vector travels for each of their words.
    turns = max(1, -(-words.count() // WORDS_AT_ONCE))
    total = lambda i: F.sum(F.col("n") * F.get("vector", F.lit(i)).cast("double"))
    wanted = []
    for turn in range(turns):
        some = words.filter(F.pmod(F.xxhash64("doc_id"), F.lit(turns)) == turn)
        sums = with_word_values(some, needed).groupBy("doc_id").agg(*[total(i).alias(f"v{i}") for i in range(size)])
        wanted.append(stored(sums.select("doc_id", F.array(*[f"v{i}" for i in range(size)]).alias("wanted")), "word-sums"))
    wanted = reduce(DataFrame.unionByName, wanted)
    dropped(words, needed)
    sized = test.withColumn("n", F.size("words"))
    found = model.transform(sized, ["doc_id", "n"]).select("doc_id", "n", vector_to_array("features").alias("found"))
    both = found.join(wanted, "doc_id", "left").withColumn(
        "wanted", F.coalesce("wanted", F.array_repeat(F.lit(0.0), size))
    )
    near = F.forall(
        F.arrays_zip("found", "wanted"),
        lambda v: F.abs(v["found"] - F.coalesce(F.try_divide(v["wanted"], F.col("n")), F.lit(0.0))) < 1e-4,
    )
    return both.select("doc_id", near.alias("agrees"))


@query
def w2v_naive_bayes(spark, sf_dir):
    train, test = _word_vectors(spark, sf_dir)
    return _predictions(ml.naive_bayes("gaussian").fit(train).transform(test))


@query
def gaussian_nb_embeddings(spark, sf_dir):
    """The likeliest label of the embeddings that ``labels`` does not judge, trained on the judged ones, and
    whether Spark ML's model has the same scores and prediction."""
    train, test = _judged_embeddings(spark, sf_dir)
    train = stored(train.select(F.col("label").alias("class_id"), "features"))
    test = stored(test.select(F.col("query_id").alias("doc_id"), "features"))
    model = gaussian.train(train)
    sums, places = gaussian.score_vectors(test, model)
    ids = F.lit([int(i) for i in places.ids])
    dense = train.select((F.array_position(ids, F.col("class_id")) - 1).cast("double").alias("label"), "features")
    dense = dense.withColumn("features", array_to_vector("features"))
    fitted = ml.naive_bayes("gaussian").fit(stored(dense))
    raw = fitted.transform(test.withColumn("features", array_to_vector("features")))
    raw = raw.select("doc_id", vector_to_array("rawPrediction").alias("raw"), (F.col("prediction") + 1).alias("at"))
    # Its scores leave out the constant of the density, the same for every class.
    apart = F.array_max("sums") - F.array_max("raw")
    near = F.forall(F.arrays_zip("sums", "raw"), lambda v: F.abs(v["sums"] - v["raw"] - apart) < 1e-6)
    best = F.array_max("sums")
    at = F.array_position("sums", best)
    return sums.join(raw, "doc_id").select(
        "doc_id",
        F.get(ids, at.cast("int") - 1).alias("prediction"),
        F.round(best, 4).alias("score"),
        (near & (at == F.col("at"))).alias("agrees"),
    )


@query
def random_forest(spark, sf_dir):
    train, test = _hashed(spark, sf_dir)
    return _predictions(ml.random_forest().fit(train).transform(test))


@query
def random_forest_w2v(spark, sf_dir):
    train, test = _word_vectors(spark, sf_dir)
    return _predictions(ml.random_forest().fit(train).transform(test))


def _predicted_best(spark, sf_dir, vectors) -> DataFrame:
    """Whether a forest's chances add up to 1 and its prediction is the likeliest class."""
    train, test = vectors(spark, sf_dir)
    found = ml.random_forest().fit(train).transform(test).select(
        "doc_id", "prediction", vector_to_array("probability").alias("p")
    )
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    best = F.get("p", F.col("prediction").cast("int")) == F.array_max("p")
    return found.select("doc_id", ((F.abs(total - 1) < 1e-9) & best).alias("agrees"))


@query
def random_forest_chances(spark, sf_dir):
    return _predicted_best(spark, sf_dir, _hashed)


@query
def forest_descent(spark, sf_dir):
    """The chances that a forest gives the pages, by descending its saved nodes as a table, against Spark's own."""
    train, test = _hashed(spark, sf_dir)
    test = stored(test.select("doc_id", "features"))
    path = scratch_path(spark, "forest")
    model = ml.random_forest().fit(train)
    ml.save_model(model, path)
    values = test.select("doc_id", F.inline(ml.entries(F.col("features"))))
    values = stored(values.withColumnsRenamed({"bucket": "feature", "n": "value"}))
    own = forest.probabilities(test, values, forest.node_table(spark, path))
    both = model.transform(test).select("doc_id", vector_to_array("probability").alias("found")).join(own, "doc_id", "left")
    near = F.forall(F.arrays_zip("found", "probability"), lambda p: F.abs(p["found"] - p["probability"]) < 1e-9)
    return both.select("doc_id", F.coalesce(near, F.lit(False)).alias("agrees"))


@query
def svm_sgd_margins(spark, sf_dir):
    """Margins of the pages for each language's machine after 100 steps of gradient descent on the TF-IDF vectors of
    the documents."""
    split = corpora.documents_and_pages(spark, sf_dir)
    vectors = V.train_and_test_vectors(split.train, split.test)
    size = vectors.dictionary.agg(F.max("feature_id")).first()[0]
    ids = [r.class_id for r in split.classes.orderBy("class_id").collect()]
    # No early end: SQL repeats all steps.
    weights, intercepts = descent.weight_tables(spark, descent.train(vectors.train, ids, size, tolerance=0.0))
    values = vectors.test.select("doc_id", F.inline("features")).withColumnRenamed("weight", "value")
    found = linear.margins(stored(values), weights, intercepts, "feature_id")
    return found.select("doc_id", "class_id", F.round("margin", 6).alias("margin"))


@query
def feature_hasher(spark, sf_dir):
    """Hashed columns of the documents are the sums of what each column gives by itself."""
    rows = stored(corpora.table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", "lang", "source", (F.col("n_chars") > 1000).alias("long")
    ))
    columns = ["n_chars", "lang", "source", "long"]
    parts = [
        rows.select("doc_id", F.col(c).alias("value")).join(ml.value_buckets(rows, c, ml.HASHER_BUCKETS), "value")
        for c in columns
    ]
    parts = reduce(DataFrame.unionByName, [p.select("doc_id", "bucket", "n") for p in parts])
    wanted = parts.groupBy("doc_id", "bucket").agg(F.sum("n").alias("n"))
    wanted = wanted.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("wanted"))
    found = ml.feature_hasher(columns).transform(rows).select("doc_id", ml.entries(F.col("features")).alias("found"))
    return found.join(wanted, "doc_id").select("doc_id", (F.col("found") == F.col("wanted")).alias("agrees"))


# --- sources and sinks --------------------------------------------------------------------------------


@query
def line_scan(spark, sf_dir):
    """Documents written as text below one folder per language, read back line by line."""
    path = scratch_path(spark, "corpus")
    documents = corpora.table(spark, sf_dir, "documents")
    lines = documents.select("lang", F.explode(T.lines(F.col("text"))).alias("line"))
    lines.write.mode("overwrite").partitionBy("lang").text(path)
    found = text_source.read_lines(spark, path, recursive=True)
    lang = F.split_part(P.directory_name(F.col("path")), F.lit("="), F.lit(2))
    return found.groupBy(lang.alias("lang")).agg(
        F.count("*").alias("n_lines"), F.sum(F.length("value")).alias("n_chars")
    )


@query
def clean_token_round_trip(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    text_source.write_clean_tokens(V.tokens_of(_by_lang(spark, sf_dir)), path)
    return text_source.read_clean_token_table(spark, path).select("doc_id", "class_id", "pos", "word")


def _mail(spark, sf_dir) -> DataFrame:
    """(conv_id, turn, role, text): all turns, and one empty message behind the last turn of each conversation."""
    turns = corpora.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    last = turns.groupBy("conv_id").agg((F.max("turn") + 1).cast(turns.schema["turn"].dataType).alias("turn"))
    return turns.unionByName(last.select("conv_id", "turn", F.lit("user").alias("role"), F.lit("").alias("text")))


@query
def whole_file_scan(spark, sf_dir):
    """Messages kept as ``<role>/<conv_id>-<turn>`` files, empty ones included."""
    root = scratch_path(spark, "files")
    name = F.concat_ws("-", "conv_id", "turn")
    text_source.write_files(_mail(spark, sf_dir).select(F.concat_ws("/", "role", name).alias("path"), "text"), root)
    return text_source.read_corpus(spark, root)


@query
def two_path_scan(spark, sf_dir):
    """The lines of two folders in one scan."""
    paths = [scratch_path(spark, "benchmark"), scratch_path(spark, "turns")]
    for path, name in zip(paths, ("benchmark", "conversations")):
        texts = corpora.table(spark, sf_dir, name).select(F.explode(T.lines(F.col("text"))))
        text_source.write_lines(texts, path)
    found = text_source.read_lines(spark, *paths).select("value")
    return found.groupBy("value").agg(F.count("*").alias("n"))


@query
def clean_file_scan(spark, sf_dir):
    """Cleaned messages kept as ``<conv_id>-a-<turn>`` files: ids repeat between the classes."""
    root = scratch_path(spark, "clean-files")
    name = P.clean_name(F.concat("conv_id", F.lit("-a")), F.col("turn"))
    text_source.write_files(K.clean_text(_mail(spark, sf_dir)).select(name.alias("path"), "text"), root)
    words = text_source.read_clean_tokens(spark, root)
    return words.groupBy("doc_id", "document", "class_id", "word").agg(F.count("*").alias("n"))


@query
def overwrite_round_trip(spark, sf_dir):
    """A table written over another one of the same path."""
    path = scratch_path(spark, "overwritten")
    tables.write_class_map(C.class_map(corpora.documents(spark, sf_dir, "lang")), path)
    tables.write_class_map(C.class_map(corpora.documents(spark, sf_dir, "source")), path)
    return tables.read_class_map(spark, path)


@query
def class_map_round_trip(spark, sf_dir):
    path = scratch_path(spark, "classes")
    tables.write_class_map(C.class_map(corpora.documents(spark, sf_dir, "source")), path)
    return tables.read_class_map(spark, path)


@query
def class_sizes_round_trip(spark, sf_dir):
    path = scratch_path(spark, "class-sizes")
    tables.write_class_sizes(class_doc_counts(spark, sf_dir), path)
    return tables.read_class_sizes(spark, path)


@query
def table_round_trip(spark, sf_dir):
    """The dictionary as tab-separated text."""
    path = scratch_path(spark, "dictionary")
    tables.write_dictionary(feature_dictionary(V.tokens_of(_by_lang(spark, sf_dir))), path)
    return tables.read_dictionary(spark, path)


@query
def side_table_rejects(spark, sf_dir):
    """Sources and lengths of the documents as lines, some without a tab, some without a number: the rows and the
    rejected lines, each with how often it occurs, and the counters of the pass that read the rows."""
    path = scratch_path(spark, "damaged")
    documents = corpora.table(spark, sf_dir, "documents")
    tab = F.when(F.col("doc_id") % 7 == 0, " ").otherwise("\t")
    number = F.concat(F.when(F.col("doc_id") % 11 == 0, "n").otherwise(""), F.col("n_chars").cast("string"))
    text_source.write_lines(documents.select(F.concat("source", tab, number).alias("value")), path)
    schema = "source string, n_chars bigint"
    pairs, counters = tables.read_counted_pairs(spark, path, schema)
    rows = stored(pairs).select(F.lit("row").alias("kind"), F.concat_ws(":", "source", "n_chars").alias("line"))
    rejects = tables.read_rejects(spark, path, schema).select(F.lit("reject").alias("kind"), "line")
    seen = counters.get
    return rows.unionByName(rejects).groupBy("kind", "line").agg(
        F.count("*").alias("n"), F.lit(seen["n_rows"]).alias("n_rows"), F.lit(seen["n_rejects"]).alias("n_rejects")
    )


@query
def tfidf_round_trip(spark, sf_dir):
    path = scratch_path(spark, "tfidf")
    weights = V.corpus_tfidf(_by_lang(spark, sf_dir))
    tables.write_tfidf(weights.withColumn("doc_id", F.concat("doc_id", F.lit("-a:b-c"))), path, "gzip")
    return tables.read_tfidf(spark, path).select("doc_id", "class_id", "word", F.round("weight", 9).alias("weight"))


@query
def bayes_counts_round_trip(spark, sf_dir):
    path = scratch_path(spark, "counts")
    tables.write_bayes_counts(bayes.train_counts(V.tokens_of(_by_source(spark, sf_dir))), path)
    return tables.read_bayes_counts(spark, path)


@query
def predictions_round_trip(spark, sf_dir):
    """Names with dashes and colons of their own: ``<doc_id>-a:b-c``."""
    path = scratch_path(spark, "predictions")
    named = nb_linear_underflow(spark, sf_dir).withColumn("doc_id", F.concat("doc_id", F.lit("-a:b-c")))
    tables.write_predictions(named, path)
    return tables.read_predictions(spark, path)


@query
def lenient_sparse_read(spark, sf_dir):
    """Vectors written as lines with their ids in descending order, read back sorted."""
    path = scratch_path(spark, "sparse")
    messages = _by_lang(spark, sf_dir)
    tf = V.counted(messages, "class_id")
    vectors = V.corpus_vectors(messages, tf)
    backwards = vectors.select(F.col("class_id").alias("label"), F.reverse("features").alias("features"))
    dropped(tf)
    sparse.write_sparse_lines(backwards, path, "gzip")
    return sparse.read_sparse_lines(spark, path).select("label", _vector_text(F.col("features")).alias("features"))


@query
def libsvm_round_trip(spark, sf_dir):
    """Rows, non-zero weights and their sum per label of vectors kept in libsvm form."""
    path = scratch_path(spark, "libsvm")
    messages = _by_lang(spark, sf_dir)
    tf = V.counted(messages, "class_id")
    words = stored(V.lexicon(messages, tf))
    vectors = V.corpus_vectors(messages, tf, words)
    size = words.agg(F.max("feature_id").alias("n")).scalar()
    sparse.write_libsvm(
        vectors.select(F.col("class_id").cast("double").alias("label"), as_ml_vector(F.col("features"), size).alias("features")),
        path,
    )
    # Spark's reader parses every line and checks its ids; the stored pairs are what the lines hold.
    parsed = sparse.read_libsvm(spark, path).groupBy("label").agg(F.count("*").alias("n"))
    pairs = sparse.read_sparse_lines(spark, path).select("label", F.inline("features")).filter("weight <> 0")
    totals = pairs.groupBy("label").agg(
        F.count("*").alias("n_weights"), F.round(F.sum("weight"), 6).alias("weight_sum")
    )
    return parsed.withColumn("label", F.col("label").cast("int")).join(totals, "label")


@query
def model_round_trip(spark, sf_dir):
    """Predictions of a saved and reloaded Naive Bayes model."""
    split = corpora.judged_and_other(spark, sf_dir, "source")
    path = scratch_path(spark, "bayes-model")
    bayes.train(K.marked_tokens(split.train)).save(path)
    model = bayes.BayesModel.load(spark, path)
    scores = bayes.log_scores(V.counted(split.test), model)
    return bayes.with_labels(bayes.predict(scores), split.test)


@query
def ml_model_round_trip(spark, sf_dir):
    """How many predictions a saved and reloaded estimator model repeats."""
    train, test = _hashed(spark, sf_dir)
    path = scratch_path(spark, "ml-model")
    fitted = ml.naive_bayes().fit(train)
    ml.save_model(fitted, path)
    again = NaiveBayesModel.load(path).transform(test).select("doc_id", F.col("prediction").alias("again"))
    both = fitted.transform(test).join(again, "doc_id")
    same = (F.col("prediction") == F.col("again")).cast("bigint")
    return both.agg(F.count("*").alias("n"), F.sum(same).alias("n_same"))


@query
def pipeline_model_round_trip(spark, sf_dir):
    """How many predictions a pipeline from raw texts repeats, cleaning included, after it was saved and loaded."""
    split = corpora.documents_and_pages(spark, sf_dir)
    train, test = (ml.labelled(messages).select("doc_id", "label", "text") for messages in (split.train, split.test))
    path = scratch_path(spark, "mail-classifier")
    fitted = ml.mail_classifier().fit(train)
    ml.save_model(fitted, path)
    again = PipelineModel.load(path).transform(test).select("doc_id", F.col("prediction").alias("again"))
    both = fitted.transform(test).select("doc_id", "prediction").join(again, "doc_id")
    same = (F.col("prediction") == F.col("again")).cast("bigint")
    return both.agg(F.count("*").alias("n"), F.sum(same).alias("n_same"))
