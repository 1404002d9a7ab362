"""Feature and classifier estimators of Spark ML, set up as this library uses them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model, Pipeline, Transformer
from pyspark.ml.classification import LinearSVC, NaiveBayes, OneVsRest, OneVsRestModel, RandomForestClassifier
from pyspark.ml.feature import IDF, FeatureHasher, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from mailsift.operators.linear import MARGIN_FLOOR, NO_CLASS
from mailsift.operators.tokens import kept_words
from mailsift.session import scratch_path

SEED = 42
BUCKETS = 5000
ENTRIES = T.ArrayType(
    T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.DoubleType())])
)


def labelled(rows: DataFrame, class_id: str = "class_id") -> DataFrame:
    """Adds ``label = class_id - 1`` as a double, the form the estimators want."""
    return rows.withColumn("label", F.col(class_id).cast("double") - 1)


class TextCleaner(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """``inputCol`` without header lines and stop words as ``outputCol``, one word per line: the cleaning as a stage,
    saved and loaded with its pipeline. A null text stays without words."""

    @keyword_only
    def __init__(self, *, inputCol: str = "text", outputCol: str = "clean"):
        super().__init__()
        self._setDefault(inputCol="text", outputCol="clean")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), F.concat_ws("\n", kept_words(F.col(self.getInputCol()))))


def mail_classifier(buckets: int = BUCKETS) -> Pipeline:
    """Raw messages to predictions: cleaning, hashed TF-IDF and Naive Bayes as one pipeline."""
    tokenizer, *rest = hashing_tfidf(buckets).getStages()
    return Pipeline(stages=[TextCleaner(), tokenizer.setInputCol("clean"), *rest, naive_bayes()])


def hashing_tfidf(buckets: int = BUCKETS) -> Pipeline:
    """text → words → hashed counts → TF-IDF ``features`` (sparse)."""
    return Pipeline(
        stages=[
            RegexTokenizer(pattern="\\s", inputCol="text", outputCol="words"),
            HashingTF(numFeatures=buckets, inputCol="words", outputCol="rawFeatures"),
            IDF(inputCol="rawFeatures", outputCol="features"),
        ]
    )


def hashed_counts(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``rawFeatures``, the hashed counts of the words of ``text``."""
    stages = hashing_tfidf(buckets).getStages()[:2]
    return Pipeline(stages=stages).fit(rows).transform(rows)


def word_buckets(words: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(word, bucket): the bucket of each distinct word, from its hashed count as a text of one word."""
    single = words.select("word").distinct().withColumn("words", F.array("word"))
    hashed = HashingTF(numFeatures=buckets, inputCol="words", outputCol="rawFeatures").transform(single)
    return hashed.select("word", F.get(entries(F.col("rawFeatures")), F.lit(0))["bucket"].alias("bucket"))


def value_buckets(rows: DataFrame, column: str, buckets: int) -> DataFrame:
    """(value, bucket, n): bucket and count of each distinct value of a column, hashed by itself."""
    values = rows.select(column).filter(F.col(column).isNotNull()).distinct()
    hashed = feature_hasher([column], buckets).transform(values)
    entry = F.get(entries(F.col("features")), F.lit(0))
    return hashed.select(F.col(column).alias("value"), entry["bucket"].alias("bucket"), entry["n"].alias("n"))


def idf_naive_bayes() -> Pipeline:
    """``rawFeatures`` counts → TF-IDF ``features`` → multinomial Naive Bayes."""
    return Pipeline(stages=[IDF(inputCol="rawFeatures", outputCol="features"), naive_bayes()])


@F.arrow_udf(ENTRIES)
def _entries(vectors: pa.Array) -> pa.Array:
    """Index and value of the entries of vectors that are not 0. A batch is handled as a few arrays, without an
    object for each entry."""
    lists = vectors.field("values")
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(vectors)), sizes)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    # A dense vector has no indices; its values stand at their places.
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sparse = vectors.field("type").fill_null(1).to_numpy(zero_copy_only=False) == 0
    at[sparse[of]] = vectors.field("indices").flatten().to_numpy(zero_copy_only=False)
    kept = values != 0
    offsets = np.append(0, np.cumsum(np.bincount(of[kept], minlength=len(vectors)))).astype(np.int32)
    found = pa.StructArray.from_arrays(
        [pa.array(at[kept].astype(np.int32)), pa.array(values[kept])], names=["bucket", "n"]
    )
    return pa.ListArray.from_arrays(pa.array(offsets), found)


def entries(vector: Column) -> Column:
    """The entries of an ML vector as (bucket, n), by bucket."""
    return _entries(vector)


def naive_bayes(model_type: str = "multinomial") -> NaiveBayes:
    """``gaussian`` for features that can be negative, such as word vectors."""
    return NaiveBayes(modelType=model_type)


def random_forest(trees: int = 20, depth: int = 30) -> RandomForestClassifier:
    """Rows keep the node they are at in each tree, so that a pass does not descend from the roots again."""
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, cacheNodeIds=True)


def linear_svm(iterations: int = 100) -> LinearSVC:
    """A linear SVM of two classes, 0 and 1."""
    return LinearSVC(maxIter=iterations, regParam=0.01)


def one_vs_rest_svm(iterations: int = 100, parallelism: int = 4) -> OneVsRest:
    """One linear SVM per class; the label column must hold 0..n-1."""
    return OneVsRest(classifier=linear_svm(iterations), parallelism=parallelism)


def weight_table(spark: SparkSession, models: list) -> tuple[DataFrame, DataFrame]:
    """(class_id, bucket, weight) and (class_id, intercept) of binary linear models, class ids from 1:
    as many rows as the hashed features have buckets."""
    weights = [
        (c, int(i), float(w)) for c, m in enumerate(models, 1) for i, w in enumerate(m.coefficients.toArray()) if w
    ]
    intercepts = [(c, float(m.intercept)) for c, m in enumerate(models, 1)]
    return (
        spark.createDataFrame(weights, "class_id int, bucket int, weight double"),
        spark.createDataFrame(intercepts, "class_id int, intercept double"),
    )


def same_weights(a, b) -> bool:
    """Whether two linear models have the same weights up to rounding."""
    return abs(a.intercept - b.intercept) < 1e-6 and abs(a.coefficients.toArray() - b.coefficients.toArray()).max() < 1e-6


def floored_class(margins: Column) -> Column:
    """The 1-based position of the largest margin, 0 when none exceeds the floor."""
    values = vector_to_array(margins)
    best = F.array_max(values)
    return F.when(best > MARGIN_FLOOR, F.array_position(values, best)).otherwise(NO_CLASS).cast("int")


def predict_one_vs_rest(model: Model, rows: DataFrame) -> DataFrame:
    """Adds ``prediction`` as a class id: raw margins, arg-max, floor. ``model`` comes ``without_summaries``."""
    scored = model.transform(rows)
    return scored.withColumn(model.getPredictionCol(), floored_class(F.col(model.getRawPredictionCol())))


HASHER_BUCKETS = 1 << 18


def feature_hasher(columns: list[str], buckets: int = HASHER_BUCKETS) -> FeatureHasher:
    """Mixed columns hashed into one vector: numbers by name, text and flags by name and value."""
    return FeatureHasher(inputCols=columns, outputCol="features", numFeatures=buckets)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def without_summaries(spark: SparkSession, model: OneVsRestModel) -> OneVsRestModel:
    """The model as it is read back after it was saved. A machine that was just fitted carries the summary of its
    training, and by it the session, into every task that predicts; that fails once the session has observed
    an action, since what it observes with cannot be sent."""
    path = scratch_path(spark, "one-vs-rest")
    save_model(model, path)
    return OneVsRestModel.load(path)
