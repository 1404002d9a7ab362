"""Estimators after an observation, and what travels between Spark and Python for their vectors."""

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation, functions as F

from mailsift.functions.features import as_ml_vector
from mailsift.operators import ml
from mailsift.operators.dictionary import feature_dictionary
from mailsift.plans import corpora, features, queries


def test_one_vs_rest_predicts_after_an_observation(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get == {"n": 3}
    rows = [(float(i % 3), float(i % 3 == 0), float(i % 3 == 1)) for i in range(30)]
    rows = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(spark.createDataFrame(rows, "label double, x double, y double"))
    model = ml.without_summaries(spark, ml.one_vs_rest_svm(20).fit(rows))
    found = ml.predict_one_vs_rest(model, rows).select("label", "prediction").collect()
    assert len(found) == 30 and {r.prediction for r in found} <= {0, 1, 2, 3}


def test_entries_make_no_object_per_entry(spark):
    rows = [(1, Vectors.sparse(9, [1, 4, 8], [2.0, 0.0, -1.0])), (2, Vectors.dense([0.0, 3.0])), (3, Vectors.sparse(9, [], []))]
    found = spark.createDataFrame(rows, ["id", "v"]).select("id", ml.entries(F.col("v")).alias("e"))
    assert {r.id: [tuple(e) for e in r.e] for r in found.collect()} == {1: [(1, 2.0), (8, -1.0)], 2: [(1, 3.0)], 3: []}
    assert "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()
    assert ml._entries.evalType == F.arrow_udf(lambda a: a, "int").evalType


def test_ml_vectors_of_lists(spark):
    features = "array<struct<feature_id:int,weight:double>>"
    rows = spark.createDataFrame([(1, [(1, 0.5), (4, 2.0)]), (2, [])], f"id int, f {features}")
    found = {r.id: r.v for r in rows.select("id", as_ml_vector(F.col("f"), F.lit(4)).alias("v")).collect()}
    assert found == {1: Vectors.sparse(4, [0, 3], [0.5, 2.0]), 2: Vectors.sparse(4, [], [])}


def test_training_texts_are_cleaned_once(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    texts = [(i, "abc"[i % 3], f"Date: x\nword{i % 5} the other{i % 7}") for i in range(30)] + [(30, "a", None), (31, "b", "")]
    rows = spark.createDataFrame(texts, "doc_id long, class_name string, text string")
    # The text of a row is read once, and before rows are dealt out by class.
    counted = rows.withColumn("text", F.udf(seen).asNondeterministic()("text"))
    monkeypatch.setattr(corpora, "documents", lambda *_: counted)
    monkeypatch.setattr(corpora, "pages", lambda *_: rows)
    train, test = queries._hashed(spark, "")
    assert read.value == len(texts)
    found = {r.doc_id: (r.label, r.features) for r in train.collect()}
    whole = ml.hashing_tfidf().fit(queries.K.clean_text(rows))
    wanted = whole.transform(ml.labelled(queries.K.clean_text(corpora.classified(rows))))
    assert found == {r.doc_id: (r.label, r.features) for r in wanted.collect()}
    assert {r.doc_id: r.features for r in test.collect()} == {d: f for d, (_, f) in found.items()}


def test_forest_keeps_the_nodes_of_rows(spark):
    rows = [(float((i * 7 % 11 > 4) + (i % 5 == 2)), float(i * 7 % 11), float(i * 3 % 13)) for i in range(120)]
    rows = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(spark.createDataFrame(rows, "label double, x double, y double"))
    forest = ml.random_forest(4, 8)
    assert forest.getCacheNodeIds()
    own, plain = (f.fit(rows).toDebugString.split("\n", 1)[1] for f in (forest, forest.copy().setCacheNodeIds(False)))
    assert own == plain


def _messages(spark):
    texts = [(1, 1, "b a-b the\nDate: x"), (2, None, "c b C"), (3, 2, ""), (4, 1, None), (2, None, "c b C")]
    return spark.createDataFrame(texts, "doc_id long, class_id int, text string")


def test_word_counts_sort_nothing_by_document(spark, monkeypatch):
    monkeypatch.setattr(features, "stored", lambda df, name="": df)
    found = features.word_counts(_messages(spark), "class_id")
    whole = features.counted(_messages(spark), "class_id")
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (found, whole)]
    assert "Window" not in plans[0] and "Sort" not in plans[0] and "Window" in plans[1]
    key = lambda r: tuple(str(v) for v in r)
    rows = [sorted((tuple(r) for r in df.select("doc_id", "class_id", "word", "cnt").collect()), key=key) for df in (found, whole)]
    assert rows[0] == rows[1] == [(1, 1, "b", 2), (2, None, "b", 2), (2, None, "c", 4)]


def test_dictionary_with_frequencies(spark, rows_of):
    words = spark.createDataFrame([(w,) for w in "dcbcdd"], "word string")
    assert rows_of(feature_dictionary(words, "n")) == [("b", 1, 1), ("c", 2, 2), ("d", 3, 3)]
    assert rows_of(feature_dictionary(words)) == [("b", 1), ("c", 2), ("d", 3)]


def test_dictionary_vectors_take_frequencies_from_the_dictionary(spark, monkeypatch):
    asked, join = [], queries.with_word_values

    def spied(rows, table, frequency=None, **others):
        asked.append(frequency)
        return join(rows, table, frequency, **others)

    monkeypatch.setattr(queries, "with_word_values", spied)
    test = spark.createDataFrame([(7, 2, "c zebra"), (8, 1, "zebra")], "doc_id long, class_id int, text string")
    monkeypatch.setattr(corpora, "documents_and_pages", lambda *_: corpora.Split(_messages(spark), test, None))
    train, test = queries._dictionary_vectors(spark, "")
    assert asked == ["n", None]
    assert {r.doc_id: (r.label, r.rawFeatures) for r in train.collect()} == {1: (0.0, Vectors.sparse(2, [0], [2.0])), 2: (None, Vectors.sparse(2, [0, 1], [2.0, 4.0]))}
    assert {r.doc_id: r.rawFeatures for r in test.collect()} == {7: Vectors.sparse(2, [1], [1.0])}
