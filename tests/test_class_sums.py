"""Scores are added up per document before they travel."""

import pytest

from mailsift.operators import bayes, classes


def test_scores_gather_no_lists_per_document(spark):
    """A shuffle of scores holds sums per document, not what every word has for every class."""
    tokens = [(c, f"w{w}", w == 0) for c in range(1, 5) for w in range(6)]
    model = bayes.train(spark.createDataFrame(tokens, "class_id int, word string, is_first boolean"))
    tf = spark.createDataFrame([(d, f"w{w}", 1 + d) for d in range(3) for w in range(8)], "doc_id long, word string, cnt long")
    sums, _ = bayes.score_vectors(tf, model)
    plan = sums._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
    assert sums.count() == 3


def test_many_classes_score_as_few_do(spark, monkeypatch):
    tokens = [(c, f"w{w}", w == 0) for c in range(1, 5) for w in range(2 + c)]
    model = bayes.train(spark.createDataFrame(tokens, "class_id int, word string, is_first boolean"))
    tf = spark.createDataFrame([(d, f"w{w}", 1 + d) for d in range(3) for w in range(8)], "doc_id long, word string, cnt long")
    few = {(r.doc_id, r.class_id): r.score for r in bayes.log_scores(tf, model).collect()}
    monkeypatch.setattr(classes, "CLASS_COLUMNS", 2)
    many = {(r.doc_id, r.class_id): r.score for r in bayes.log_scores(tf, model).collect()}
    assert len(few) == 12 and few.keys() == many.keys()
    assert [few[k] for k in few] == pytest.approx([many[k] for k in few])
