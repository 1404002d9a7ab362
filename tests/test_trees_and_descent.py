"""Forests as tables, gradient descent, word tables and the cleaning stage, against plain code."""

import random

import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from mailsift.functions.features import FEATURES_TYPE
from mailsift.operators import descent, forest, ml, tokens
from mailsift.operators.words import WordTables


def test_forest_equals_a_walk_and_sparks_own(spark, tmp_path):
    draw = random.Random(2)
    rows = [[draw.choice([0.0, 0.0, draw.random()]) for _ in range(6)] for _ in range(80)]
    labels = [float((r[0] > 0.4) + (r[1] > 0.2)) for r in rows]
    train = spark.createDataFrame([(i, y, Vectors.dense(r)) for i, (y, r) in enumerate(zip(labels, rows))], ["doc_id", "label", "features"])
    model = ml.random_forest(4, 12).fit(train)
    path = f"file://{tmp_path}/forest"
    ml.save_model(model, path)
    nodes = forest.node_table(spark, path)
    values = [(i, f, v) for i, r in enumerate(rows) for f, v in enumerate(r) if v]
    features = spark.createDataFrame(values, "doc_id long, feature int, value double")
    # A repeated document counts once.
    documents = train.select("doc_id").union(train.select("doc_id").limit(3))
    found = {r.doc_id: r.probability for r in forest.probabilities(documents, features, nodes).collect()}
    own = {r.doc_id: list(r.probability) for r in model.transform(train).collect()}
    assert found.keys() == own.keys()
    assert all(np.allclose(found[d], own[d], atol=1e-9) for d in own)
    table = {(n.tree, n.node): n for n in nodes.collect()}
    wanted = set()
    for i, r in enumerate(rows):
        for tree in range(4):
            node = table[tree, 0]
            while node.feature is not None:
                node = table[tree, node.left if r[node.feature] <= node.threshold else node.right]
            wanted.add((i, tree, node.node))
    assert {tuple(r) for r in forest.leaves(documents, features, nodes).collect()} == wanted
    assert not forest.probabilities(documents.limit(0), features, nodes).collect()


def test_descent_equals_plain_steps(spark):
    draw = random.Random(3)
    rows = [(draw.choice([1, 2, 3, None]), sorted(draw.sample(range(1, 9), 3))) for _ in range(40)]
    rows = [(c, [(i, draw.random() * 3) for i in ids]) for c, ids in rows]
    models = descent.train(spark.createDataFrame(rows, f"class_id int, features {FEATURES_TYPE}"), [1, 2, 3], 8, 30, 0.0)
    x = np.zeros((len(rows), 8))
    for at, (_, features) in enumerate(rows):
        for i, w in features:
            x[at, i - 1] = w
    for own in (1, 2, 3):
        y, w = np.array([1 if c == own else -1 for c, _ in rows]), np.zeros(8)
        for step in range(1, 31):
            pull = (x * (y * (y * (x @ w) < 1))[:, None]).mean(axis=0)
            w = w * (1 - 0.01 / step**0.5) + pull / step**0.5
        assert np.allclose(models[own].weights.toArray(), w, atol=1e-9)
    weights, intercepts = descent.weight_tables(spark, models)
    assert weights.count() == sum(int((m.weights.toArray() != 0).sum()) for m in models.values())
    assert intercepts.count() == 3


def test_all_machines_descend_in_one_pass(spark):
    draw = random.Random(5)
    rows = [(draw.choice([1, 2, 3, None]), [(i, draw.random()) for i in sorted(draw.sample(range(1, 30), 4))]) for _ in range(60)]
    rows = spark.createDataFrame([*rows, (2, [])], f"class_id int, features {FEATURES_TYPE}")
    sc = spark.sparkContext
    sc.setJobGroup("descent", "one pass a step")
    models = descent.train(rows, [1, 2, 3], 29, 20, 0.0)
    sc.setJobGroup("", "")
    assert len(sc.statusTracker().getJobIdsForGroup("descent")) < 40
    # The machines end one by one where they hardly move, as MLlib's do.
    from pyspark.mllib.classification import SVMWithSGD
    from pyspark.mllib.linalg import Vectors as Old
    from pyspark.mllib.regression import LabeledPoint

    ended = descent.train(rows, [1, 2, 3], 29, 60, 0.05)
    for own in (1, 2, 3):
        points = [LabeledPoint(float(r.class_id == own), Old.sparse(29, [(f.feature_id - 1, f.weight) for f in r.features])) for r in rows.collect()]
        for found, end in ((models, (20, 0.0)), (ended, (60, 0.05))):
            wanted = SVMWithSGD.train(sc.parallelize(points), iterations=end[0], convergenceTol=end[1])
            assert np.allclose(found[own].weights.toArray(), wanted.weights.toArray(), atol=1e-9)


def test_blocks_of_the_descent_are_small_and_read_one_by_one(spark, monkeypatch):
    draw = random.Random(6)
    rows = [(draw.choice([1, 2, None]), [(f, draw.random()) for f in sorted(draw.sample(range(1, 60), 6))]) for _ in range(200)]
    rows = spark.createDataFrame(rows, f"class_id int, features {FEATURES_TYPE}")
    wanted = descent.train(rows, [1, 2], 60, 5, 0.0)
    monkeypatch.setattr(descent, "BLOCK_ENTRIES", 30)
    monkeypatch.setattr(descent, "SENT", 7)
    blocks = descent._packed(rows, [1, 2])
    sizes = [len(r.at) // 4 for r in blocks.collect()]
    assert sum(sizes) == 1200 and max(sizes) <= 30
    assert len(blocks.inputFiles()) == len(sizes) and blocks.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    found = descent.train(rows, [1, 2], 60, 5, 0.0)
    assert all(np.allclose(found[c].weights.toArray(), wanted[c].weights.toArray(), atol=1e-12) for c in (1, 2))


def test_word_tables_meet_without_exchange(spark, rows_of):
    draw = random.Random(4)
    words = [f"w{int(draw.paretovariate(0.6))}" for _ in range(300)] + ["the"] * 200
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "doc_id long, word string")
    values = rows.select("word").distinct().withColumn("n", F.length("word"))
    kept = WordTables(spark, 4)
    left, right = kept.rows(rows, "rows"), kept.values(values, "values")
    assert rows_of(kept.join(left, right)) == rows_of(rows.join(values, "word").select("word", "doc_id", "n"))
    many = left[1].join(right[1].hint("merge"), "word")
    assert "Exchange" not in many._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in many._jdf.queryExecution().executedPlan().toString()


def test_cleaning_as_a_stage_and_its_counters(spark, tmp_path):
    texts = ["From: x\nThe cat and the dog\nDate: y", "", None, "the"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    path = f"file://{tmp_path}/cleaner"
    ml.TextCleaner(outputCol="words").write().overwrite().save(path)
    found = ml.TextCleaner.load(path).transform(rows).orderBy("doc_id")
    assert [r["words"] for r in found.collect()] == ["cat\ndog", "", "", ""]
    cleaned, counters = tokens.counted_clean_text(rows)
    assert sorted(r.text for r in cleaned.collect()) == ["", "", "", "cat\ndog"]
    assert counters.get == {
        "messages": 4, "header_lines": 2, "letter_runs": 6, "stop_words": 4, "words": 2, "empty_messages": 3,
    }
