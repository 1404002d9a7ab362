import math
import random

import pytest
from pyspark.sql import functions as F

from mailsift.functions.features import FEATURES_TYPE
from mailsift.operators import bayes, evaluate, knn, linear, ml

TRAIN = [
    (1, 1, "cat cat dog"), (2, 1, "cat mouse"), (3, 2, "car bus car"), (4, 2, "bus dog"), (5, 2, "van"),
]
TEST = [(10, "cat car unknown"), (11, "bus bus"), (12, "nothing known")]


def tokens(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    words = df.select("*", F.posexplode(F.split("text", " ")).alias("at", "word"))
    return words.withColumn("is_first", F.col("at") == 0).drop("text", "at")


@pytest.fixture(scope="module")
def model(spark):
    return bayes.train(tokens(spark, TRAIN, "doc_id bigint, class_id int, text string"))


@pytest.fixture(scope="module")
def tf(spark):
    return tokens(spark, TEST, "doc_id bigint, text string").groupBy("doc_id", "word").agg(F.count("*").alias("cnt"))


def direct_scores(prior=True):
    counts, totals, docs, vocabulary = {}, {}, {}, set()
    for _, c, text in TRAIN:
        docs[c] = docs.get(c, 0) + 1
        for w in text.split():
            counts[c, w] = counts.get((c, w), 0) + 1
            totals[c] = totals.get(c, 0) + 1
            vocabulary.add(w)
    out = {}
    for d, text in TEST:
        for c in totals:
            out[d, c] = math.log(docs[c] / len(TRAIN)) if prior else 0.0
            for w in text.split():
                out[d, c] += math.log((counts.get((c, w), 0) + 1) / (totals[c] + len(vocabulary)))
    return out


@pytest.mark.parametrize("prior", ["documents", "uniform"])
def test_log_scores_equal_the_direct_form(model, tf, prior):
    found = {(r.doc_id, r.class_id): r.score for r in bayes.log_scores(tf, model, prior).collect()}
    assert found == pytest.approx(direct_scores(prior == "documents"))


def test_predictions(spark, model, tf, rows_of):
    scores = bayes.log_scores(tf, model)
    direct = direct_scores()
    best = [(d, max((1, 2), key=lambda c: (direct[d, c], -c))) for d, _ in TEST]
    assert rows_of(bayes.predict(scores)) == best
    assert rows_of(bayes.predict_linear(scores)) == best
    messages = spark.createDataFrame([(d, t) for d, t in TEST] + [(13, "")], "doc_id bigint, text string")
    assert rows_of(bayes.with_empty(bayes.predict(scores), messages, model)) == best + [(13, 2)]


def test_linear_domain_underflows(spark, rows_of):
    scores = spark.createDataFrame(
        [(1, 1, -800.0), (1, 2, -900.0), (2, 1, -700.0), (2, 2, -800.0)], "doc_id bigint, class_id int, score double"
    )
    assert bayes.predict_linear(scores).orderBy("doc_id").collect() == [(1, None), (2, 1)]
    assert rows_of(bayes.predict(scores)) == [(1, 1), (2, 1)]


def test_linear_scores_equal_the_product(spark, model, tf):
    products = {k: math.exp(v) for k, v in direct_scores().items()}
    linear_scores = bayes.linear_scores(bayes.log_scores(tf, model)).collect()
    assert {(r.doc_id, r.class_id): r.score for r in linear_scores} == pytest.approx(products)


def test_equal_scores_go_to_the_smallest_class(spark, rows_of):
    scores = spark.createDataFrame([(1, 3, -1.0), (1, 2, -1.0), (1, 4, -2.0)], "doc_id bigint, class_id int, score double")
    assert rows_of(bayes.predict(scores)) == [(1, 2)]


def test_model_round_trip(spark, model, tf, rows_of, tmp_path):
    model.save(str(tmp_path / "model"))
    again = bayes.BayesModel.load(spark, str(tmp_path / "model"))
    assert rows_of(bayes.log_scores(tf, again)) == rows_of(bayes.log_scores(tf, model))


def test_many_classes(spark):
    rows = [(c, f"w{c % 7}", True) for c in range(1, 1201)] + [(c, "all", False) for c in range(1, 1201)]
    model = bayes.train(spark.createDataFrame(rows, "class_id int, word string, is_first boolean"))
    assert model.classes.count() == 1200
    tf = spark.createDataFrame([(1, "w3", 2), (1, "new", 1)], "doc_id bigint, word string, cnt bigint")
    scores = bayes.log_scores(tf, model)
    assert scores.count() == 1200
    assert bayes.predict(scores).collect() == [(1, 3)]
    weights = bayes.log_odds(model.counts)
    intercepts = model.classes.select("class_id", F.col("log_prior").alias("intercept"))
    values = tf.select("doc_id", "word", F.col("cnt").cast("double").alias("value"))
    found = linear.predict(linear.margins(values, weights, intercepts, "word")).collect()
    assert found[0].prediction in (0, 3)


def test_close_scores_in_the_denormal_range_keep_their_order(spark):
    scores = spark.createDataFrame(
        [(1, 1, -744.05), (1, 2, -744.04)], "doc_id bigint, class_id int, score double"
    )
    assert bayes.predict_linear(scores).collect() == [(1, 2)]


def test_metrics_with_classes_never_predicted(spark, rows_of):
    pairs = [(1, 1), (1, 2), (2, 2), (3, 2), (2, None)]
    predictions = spark.createDataFrame(pairs, "label int, prediction int")
    assert evaluate.accuracy(predictions).collect()[0] == (5, 2, 0.4)
    found = rows_of(evaluate.class_metrics(evaluate.confusion_matrix(predictions)))
    assert found[0] == (1, 2, 1, 1.0, 0.5, pytest.approx(2 / 3))
    assert found[1] == (2, 2, 3, pytest.approx(1 / 3), 0.5, pytest.approx(0.4))
    assert found[2] == (3, 1, 0, 0.0, 0.0, 0.0)


# --- nearest neighbours ---------------------------------------------------------------------------


def brute_force(test, train, k):
    out = []
    for q, a in test:
        a = dict(a)
        ranked = []
        for t, label, b in train:
            b = dict(b)
            ids = set(a) | set(b)
            d = math.sqrt(sum((a.get(i, 0.0) - b.get(i, 0.0)) ** 2 for i in ids))
            ranked.append((round(d, 6), t, label))
        out += [(q, i, t, label, d) for i, (d, t, label) in enumerate(sorted(ranked)[:k], 1)]
    return sorted(out)


def random_rows(rng, n, signed=False, dense=False):
    rows = []
    for _ in range(n):
        scale = 10 ** rng.uniform(-2, 1.5)
        ids = range(1, 9) if dense else sorted(rng.sample(range(1, 60), rng.randint(1, 12)))
        low = -1.0 if signed else 0.0
        rows.append([(i, round(rng.uniform(low, 1.0) * scale, 4)) for i in ids])
    # A third of all rows are copies of one row.
    return rows + [list(rows[0]) for _ in range(n // 2)]


@pytest.mark.parametrize("signed, dense, k", [(False, False, 5), (True, False, 3), (True, True, 4), (False, False, 500)])
def test_nearest_equals_brute_force(spark, monkeypatch, signed, dense, k):
    monkeypatch.setattr(knn, "TILE_ROWS", 16)
    monkeypatch.setattr(knn, "_SLAB", 50)
    rng = random.Random(7)
    test = [(i, f) for i, f in enumerate(random_rows(rng, 40, signed, dense))]
    train = [(i, rng.randint(1, 4), f) for i, f in enumerate(random_rows(rng, 120, signed, dense))]
    queries = spark.createDataFrame(test, f"query_id bigint, features {FEATURES_TYPE}")
    points = spark.createDataFrame(train, f"train_id bigint, label int, features {FEATURES_TYPE}")
    if dense:
        queries, points = (rows.withColumn("features", F.col("features.weight")) for rows in (queries, points))
    found = knn.nearest(queries, points, k=k, non_negative=not signed, dense=dense)
    rows = sorted(tuple(r) for r in found.select("query_id", "rank", "train_id", "label", "distance").collect())
    expected = brute_force(test, train, k)
    assert len(rows) == len(expected) == len(test) * min(k, len(train))
    if rows != expected:  # rounding at the last decimal may differ from the direct sum
        assert [r[4] for r in rows] == pytest.approx([e[4] for e in expected], abs=2e-6)


def test_zero_vectors_and_far_groups(spark):
    test = [(1, [(1, 100.0)]), (2, [(1, 0.0)])]
    train = [(1, 1, [(1, 0.0)]), (2, 2, [(2, 0.001)]), (3, 3, [(1, 99.0)]), (4, 4, [(2, 500.0)])]
    found = knn.nearest(
        spark.createDataFrame(test, f"query_id bigint, features {FEATURES_TYPE}"),
        spark.createDataFrame(train, f"train_id bigint, label int, features {FEATURES_TYPE}"),
        k=2,
    )
    rows = sorted((r.query_id, r.rank, r.train_id, r.distance) for r in found.collect())
    assert rows == [(1, 1, 3, 1.0), (1, 2, 1, 100.0), (2, 1, 1, 0.0), (2, 2, 2, 0.001)]


def test_unit_vectors_in_clusters_meet_few_cells(spark, monkeypatch):
    """Norms tell nothing about unit vectors; the pivots do."""
    monkeypatch.setattr(knn, "TILE_ROWS", 64)
    rng = random.Random(11)

    def unit(values):
        norm = math.sqrt(sum(v * v for v in values))
        return [(i, v / norm) for i, v in enumerate(values)]

    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(30)]
    near = lambda: unit([c + rng.gauss(0, 0.02) for c in rng.choice(centres)])
    test = [(i, near()) for i in range(100)]
    train = [(i, 1, near()) for i in range(1500)]
    queries = spark.createDataFrame(test, f"query_id bigint, features {FEATURES_TYPE}")
    points = spark.createDataFrame(train, f"train_id bigint, label int, features {FEATURES_TYPE}")
    queries, points = (rows.withColumn("features", F.col("features.weight")) for rows in (queries, points))
    compared = knn.candidates(queries, points, k=5, non_negative=False, dense=True).collect()
    assert len(compared) == len(test)
    assert sum(r.n_candidates for r in compared) <= 0.2 * len(test) * len(train)
    found = knn.nearest(queries, points, k=5, non_negative=False, dense=True)
    rows = sorted(tuple(r) for r in found.select("query_id", "rank", "train_id", "label", "distance").collect())
    assert [r[4] for r in rows] == pytest.approx([e[4] for e in brute_force(test, train, 5)], abs=2e-6)


@pytest.mark.parametrize("dense", [False, True])
def test_nearest_of_odd_rows(spark, dense):
    """Rows without features have no neighbours and are none; labels can be null; an empty side gives nothing."""
    features = "array<double>" if dense else FEATURES_TYPE
    row = [1.0, 2.0] if dense else [(1, 1.0), (2, 2.0)]
    queries = spark.createDataFrame([(1, row), (2, None)], f"query_id bigint, features {features}")
    points = spark.createDataFrame(
        [(1, None, row), (2, 5, None), (3, 5, row)], f"train_id bigint, label int, features {features}"
    )
    found = knn.nearest(queries, points, k=5, dense=dense).collect()
    assert sorted(tuple(r) for r in found) == [(1, 1, 1, None, 0.0), (1, 2, 3, 5, 0.0)]
    assert not knn.nearest(queries, points.limit(0), k=5, dense=dense).collect()
    assert not knn.nearest(queries.limit(0), points, k=5, dense=dense).collect()


@pytest.mark.parametrize(
    "labels, expected",
    [([1, 1, 2, 2, 2], 2), ([1, 2, 3], 0), ([1, 2, 2, 1], 2), ([2, 1, 1, 2, 3, 3], 1), ([5, 5], 5)],
)
def test_vote(spark, labels, expected):
    rows = [(1, i, label) for i, label in enumerate(labels)]
    neighbours = spark.createDataFrame(rows, "query_id bigint, train_id bigint, label int")
    assert knn.vote(neighbours).collect()[0].prediction == expected


def test_vote_follows_its_rule(spark):
    """The highest count wins; among labels that have it, the one whose last vote comes first; below
    two votes there is none."""
    rng = random.Random(3)
    lists = [[rng.randint(1, 4) for _ in range(rng.randint(1, 9))] for _ in range(400)]

    def winner(labels):
        most = max(labels.count(x) for x in labels)
        last = {x: max(i for i, y in enumerate(labels) if y == x) for x in labels if labels.count(x) == most}
        return min(last, key=last.get) if most > 1 else 0

    rows = [(q, i, label) for q, labels in enumerate(lists) for i, label in enumerate(labels)]
    found = knn.vote(spark.createDataFrame(rows, "query_id bigint, train_id bigint, label int"))
    assert dict(found.collect()) == {q: winner(labels) for q, labels in enumerate(lists)}


@pytest.mark.parametrize(
    "a, b",
    [([(1, 1.0), (2, 1.0), (3, 1.0)], [(1, 2.0), (2, 2.0), (3, 2.0)]), ([(1, 1.0), (2, 1.0), (3, 1.0)], [(1, 1.0), (4, 1.0)])],
)
def test_distance_of_two_vectors(spark, a, b):
    queries = spark.createDataFrame([(1, a)], f"query_id bigint, features {FEATURES_TYPE}")
    points = spark.createDataFrame([(1, 1, b)], f"train_id bigint, label int, features {FEATURES_TYPE}")
    assert knn.nearest(queries, points, k=1).collect()[0].distance == pytest.approx(math.sqrt(3), abs=1e-5)


def test_dense_rows_of_other_lengths_are_named(spark):
    queries = spark.createDataFrame([(7, [1.0])], "query_id bigint, features array<double>")
    points = spark.createDataFrame([(1, 1, [1.0, 2.0])], "train_id bigint, label int, features array<double>")
    with pytest.raises(Exception, match="query_id 7"):
        knn.nearest(queries, points, k=1, dense=True).collect()


# --- linear models --------------------------------------------------------------------------------


def test_margins_and_floor(spark, rows_of):
    features = spark.createDataFrame([(1, 7, 2.0), (1, 8, 1.0), (2, 9, 1.0), (3, 8, 4.0)], "doc_id bigint, feature_id int, value double")
    weights = spark.createDataFrame([(1, 7, 0.5), (2, 8, -1.0), (1, 8, -1.0)], "class_id int, feature_id int, weight double")
    intercepts = spark.createDataFrame([(1, -0.5), (2, 0.25)], "class_id int, intercept double")
    found = linear.margins(features, weights, intercepts, "feature_id")
    assert rows_of(found) == [(1, 1, -0.5), (1, 2, -0.75), (2, 1, -0.5), (2, 2, 0.25), (3, 1, -4.5), (3, 2, -3.75)]
    assert rows_of(linear.predict(found)) == [(1, -0.5, 1), (2, 0.25, 2), (3, -3.75, 0)]


def test_binarise(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,)], "label double")
    assert [r.label for r in linear.binarise(rows, 2).collect()] == [0.0, 1.0]


def test_floored_class(spark):
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(Vectors.dense(-2.0, 0.5),), (Vectors.dense(-1.0, -3.0),)], ["margins"])
    assert [r[0] for r in rows.select(ml.floored_class(F.col("margins"))).collect()] == [2, 0]
