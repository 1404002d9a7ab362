"""Sums of class values per document, and Gaussian densities, against plain loops."""

import math
import random

import pytest

from mailsift.operators import classes, gaussian


@pytest.mark.parametrize("at_once", [1, 1 << 22])
def test_class_sums_equal_plain_loops(spark, monkeypatch, at_once):
    monkeypatch.setattr(classes, "SUMS_AT_ONCE", at_once)
    draw = random.Random(4)
    ids = sorted(draw.sample(range(10_000), 300))
    places = classes.Places.of(spark.createDataFrame([(i, i / 7) for i in ids], "class_id int, base double"), "base")
    rows, wanted = [], {}
    for doc in range(40):
        sums = [i / 7 for i in ids]
        for _ in range(draw.randint(1, 6)):
            weight = draw.choice([-1.5, 0.0, 2.0, 3.0])
            listed = None if draw.random() < 0.2 else [(c, draw.random()) for c in draw.sample(ids, draw.randint(0, 9))]
            rows.append((doc, weight, listed))
            sums = [s + 10 * weight for s in sums]
            for c, v in listed or []:
                sums[ids.index(c)] += weight * v
        wanted[doc] = sums
    df = spark.createDataFrame(rows, "doc_id long, weight double, by_class array<struct<class_id:int,value:double>>")
    base = places.constants["base"]
    found = classes.vector_sums(df, places, lambda totals: base + 10 * totals[:, None])
    got = {r.doc_id: r.sums for r in found.collect()}
    assert got.keys() == wanted.keys()
    assert all(math.isclose(a, b, abs_tol=1e-9) for d in got for a, b in zip(got[d], wanted[d], strict=True))
    best = {r.doc_id: r.class_id for r in classes.likeliest(found, places).collect()}
    assert best == {d: ids[got[d].index(max(got[d]))] for d in got}
    assert classes.by_class(found, places, "s").count() == 40 * 300


def test_gaussian_densities_equal_plain_loops(spark):
    draw = random.Random(5)
    train = [(draw.choice([2, 5, 9]), [draw.gauss(0, 1), draw.gauss(3, 2), 1.0]) for _ in range(60)]
    odd = [(None, [1.0, 2.0, 3.0]), (2, None)]
    model = gaussian.train(spark.createDataFrame(train + odd, "class_id int, features array<double>"))
    tests = [(i, [draw.gauss(0, 1), draw.gauss(3, 2), 1.0]) for i in range(20)] + [(20, None)]
    found = {
        (r.doc_id, r.class_id): r.score
        for r in gaussian.log_scores(spark.createDataFrame(tests, "doc_id long, features array<double>"), model).collect()
    }

    def variance(values):
        return sum(v * v for v in values) / len(values) - (sum(values) / len(values)) ** 2

    columns = list(zip(*[x for _, x in train]))
    smooth = 1e-9 * max(variance(c) for c in columns)
    assert len(found) == 20 * 3
    for (doc, label), score in found.items():
        own = list(zip(*[x for c, x in train if c == label]))
        total = math.log(len(own[0]) / len(train))
        for x, values in zip(tests[doc][1], own):
            v, mean = variance(values) + smooth, sum(values) / len(values)
            total -= 0.5 * (math.log(2 * math.pi * v) + (x - mean) ** 2 / v)
        assert math.isclose(score, total, rel_tol=1e-6)
