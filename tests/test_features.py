import math

import pytest
from pyspark.sql import functions as F

from mailsift.operators import classes as C, dictionary as D, tfidf as TF, words as W
from mailsift.operators.vectors import sparse_vectors, unmatched_features
from mailsift.plans import features as V


@pytest.fixture
def messages(spark):
    return spark.createDataFrame(
        [(1, 1, "apple apple pear"), (2, 1, "apple plum"), (3, 2, "plum plum fig"), (4, 2, "!")],
        "doc_id bigint, class_id int, text string",
    )


def test_tfidf_counts_empty_messages(messages, rows_of):
    weights = {(d, w): x for d, _, w, x in rows_of(V.corpus_tfidf(messages))}
    assert weights[(1, "apple")] == pytest.approx(2 / 3 * math.log10(5 / 3))
    assert weights[(3, "fig")] == pytest.approx(1 / 3 * math.log10(5 / 2))
    assert len(weights) == 6


def test_dictionary_is_dense_and_in_byte_order(spark, rows_of):
    words = ["b", "a", "Z", "é", "zz", "z", "a"] + [f"w{i}" for i in range(500)]
    tokens = spark.createDataFrame([(w,) for w in words], "word string").repartition(5)
    found = rows_of(D.feature_dictionary(tokens))
    expected = sorted(set(words), key=lambda w: w.encode())
    assert sorted((n, w) for w, n in found) == list(enumerate(expected, 1))


def test_vectors_and_rejects(spark, messages, rows_of):
    weights = V.corpus_tfidf(messages)
    dictionary = spark.createDataFrame([("apple", 2), ("plum", 1)], "word string, feature_id int")
    vectors = {r.doc_id: [f.feature_id for f in r.features] for r in sparse_vectors(weights, dictionary).collect()}
    assert vectors == {1: [2], 2: [1, 2], 3: [1]}
    assert {w for _, _, w, _ in rows_of(unmatched_features(weights, dictionary))} == {"pear", "fig"}


def test_applied_vectors_use_either_idf(spark, messages):
    words = V.lexicon(messages)
    other = spark.createDataFrame([(9, 1, "plum plum new")], "doc_id bigint, class_id int, text string")
    trained = V.applied_vectors(other, words).collect()[0].features
    own = V.applied_vectors(other, words, idf_from="self").collect()[0].features
    assert [f.feature_id for f in trained] == [f.feature_id for f in own] == [4]
    assert trained[0].weight == pytest.approx(2 / 3 * math.log10(5 / 3))
    assert own[0].weight == 0.0


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_word_join_equals_plain_join_whatever_is_hot(spark, rows_of, monkeypatch, hot):
    monkeypatch.setattr(W, "HOT_WORDS", hot)
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "the").otherwise(F.concat(F.lit("w"), (F.col("id") % 40).cast("string"))).alias("word"),
    )
    table = rows.groupBy("word").agg(F.count("*").alias("df")).filter("word <> 'w7'")
    plain = rows_of(rows.join(table, "word").select("doc_id", "word", "df"))
    assert rows_of(W.with_word_values(rows, table, "df")) == plain
    assert rows_of(W.with_word_values(rows, table)) == plain
    rejects = rows_of(rows.join(table, "word", "left_anti").select("doc_id", "word"))
    assert rejects and rows_of(W.without_word_values(rows, table)) == rejects
    assert W.with_word_values(rows, table, "df", keep_unknown=True).count() == 3000
    rare = table.filter("word <> 'the'")  # the hottest word of the rows is not in the table
    assert rows_of(W.without_word_values(rows, rare)) == rows_of(
        rows.join(rare, "word", "left_anti").select("doc_id", "word")
    )
    known = W.with_word_values(rows, rare, keep_unknown=True)
    assert known.filter("word = 'the' and df is null").count() == 1000
    assert known.count() == 3000


def test_words_of_any_form_and_an_absent_hot_word(spark, monkeypatch, rows_of):
    monkeypatch.setattr(W, "HOT_WORDS", 4)
    rows = spark.createDataFrame([(i, "hot") for i in range(20)] + [(50, "#0")], "doc_id bigint, word string")
    table = spark.createDataFrame([(f"#{i}", i) for i in range(4)], "word string, df int")
    assert rows_of(W.with_word_values(rows, table)) == [(50, "#0", 0)]
    kept = W.with_word_values(rows, table, keep_unknown=True)
    assert kept.count() == 21 and kept.filter("df is null").count() == 20


def test_tfidf_splits_texts_once(spark, messages):
    plan = V.corpus_tfidf(messages)._jdf.queryExecution().toString()
    assert "regexp_extract_all" not in plan and "TakeOrdered" not in plan


def test_class_map_and_lookup(spark, rows_of):
    messages = spark.createDataFrame(
        [(1, "b", "x"), (2, "B", "y"), (3, "b", "")], "doc_id bigint, class_name string, text string"
    )
    classes = C.class_map(messages)
    assert rows_of(classes) == [(1, "B"), (2, "b")]
    other = spark.createDataFrame([(7, "unknown", "x")], "doc_id bigint, class_name string, text string")
    assert C.with_class_id(other, classes).collect()[0].class_id is None
    known = C.with_class_id(messages, classes)
    assert rows_of(C.class_doc_counts(known, F.length("text"))) == [(1, 1), (2, 1)]


def test_thousands_of_classes(spark):
    rows = spark.range(5000).select(F.format_string("c%04d", "id").alias("class_name"))
    found = C.class_map(rows.union(rows)).collect()
    assert [(r.class_id, r.class_name) for r in sorted(found)] == [(i + 1, f"c{i:04d}") for i in range(5000)]


def test_corpus_size_is_part_of_the_plan(messages):
    assert messages.limit(1).select(TF.corpus_size(messages).alias("n")).collect()[0].n == 4
