import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from mailsift.llm import decontaminate, mixing, quality, sharding, simhash
from mailsift.llm.common import gapless_rank, table

SF_DIR = "/root/testdata/sf0.001"


def held_out(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def judged(documents, spark):
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    rows, labels = [], []
    for i in range(600):
        good = rng.random() < 0.8
        text = " ".join(word() for _ in range(rng.randint(20, 80))) + "."
        rows.append((i, text if good else " ".join([word() + "!!"] * 60).upper(), "s"))
        labels.append((i, int(good), 0))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_scores_separate_held_out_documents(documents, judged, by_id):
    rows, labels = judged
    found = by_id(quality.classify(documents(rows, x="1", y="2", score="3"), labels))
    wanted = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == held_out(i) for i, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    out = [(r.score, wanted[i]) for i, r in found.items() if r.held_out]
    good, bad = [s for s, y in out if y], [s for s, y in out if not y]
    assert np.mean([a > b for a in good for b in bad]) > 0.99
    kept = quality.good_documents(documents(rows, x="1"), labels)
    assert kept.columns[-1] == "x"
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.predicted}


def test_held_out_labels_and_other_columns_do_not_matter(documents, judged, spark, by_id):
    rows, labels = judged
    turned = spark.createDataFrame(
        [(r.doc_id, 1 - r.quality if held_out(r.doc_id) else r.quality, 1) for r in labels.collect()], labels.schema
    )
    first = by_id(quality.classify(documents(rows), labels))
    second = by_id(quality.classify(documents([(i, t, "q") for i, t, _ in rows]), turned))
    assert {i: r.score for i, r in first.items()} == pytest.approx({i: r.score for i, r in second.items()})


def test_odd_rows_and_labels(documents, spark):
    rows = [(None, None, None), (1, "", "s"), (1, "", "s"), (2, "a\n\n\x00b", "s"), (3, "x" * 400_000, "s")]
    schema = "doc_id long, quality int, toxic int"
    for labels in ([], [(1, None, 0), (99, 1, 0)], [(1, 1, 0), (None, 0, 0), (3, 1, 0), (2, 1, 1)]):
        found = quality.classify(documents(rows), spark.createDataFrame(labels, schema)).collect()
        assert len(found) == 5 and all(0 <= r.score <= 1 for r in found)
        assert next(r for r in found if r.doc_id is None).held_out
    none = spark.createDataFrame([], schema)
    assert quality.classify(documents([]), none).collect() == []
    assert quality.good_documents(documents(rows), none).count() == 5


def test_isotonic_pools():
    knots, values = quality.isotonic(np.array([0.0, 1, 2, 3]), np.array([1.0, 0, 1, 2]), np.array([1.0, 1, 1, 2]))
    assert list(values) == [0.5, 1.0, 1.0] or list(values) == [0.5, 1.0]
    assert all(a <= b for a, b in zip(values, values[1:])) and knots[0] == 0.5


def test_gapless_rank_of_a_hot_group(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 3 = 0, null, 'a') as g", "id % 2 as h")
    found = gapless_rank(df, ["g", "h"], [df.id], df.id, "n").collect()
    for g in (None, "a"):
        for h in (0, 1):
            ranks = sorted(r.n for r in found if r.g == g and r.h == h)
            assert ranks == list(range(len(ranks))) and ranks


def test_pipeline_equals_its_operators_one_by_one(spark):
    docs = table(spark, SF_DIR, "documents")
    predicted = quality.classify(docs, table(spark, SF_DIR, "labels")).filter("predicted = 1")
    good = {r.doc_id for r in predicted.collect()}
    rest = docs.filter(docs.doc_id.isin(list(good))).cache()
    first = {r.component_id for r in simhash.near_duplicates(rest).collect()}
    rest = docs.filter(docs.doc_id.isin(list(first)))
    leaking = {r.doc_id for r in decontaminate.leaks(rest, table(spark, SF_DIR, "benchmark")).collect()}
    clean = docs.filter(docs.doc_id.isin(list(first - leaking)))
    copies = {r.doc_id: r.copies for r in mixing.mix(clean).collect()}
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    counted = {}
    for r in found:
        counted[r.doc_id] = counted.get(r.doc_id, 0) + 1
    assert counted == {i: n for i, n in copies.items() if n} and leaking
    shards = {r.doc_id: r.shard for r in sharding.assign(clean).collect()}
    assert all(r.shard == shards[r.doc_id] for r in found)
    assert [s for s, _ in corpus_pipeline.STAGES] == ["quality", "near-duplicates", "decontamination", "mixing", "sharding"]


def test_stages_keep_columns_and_take_odd_tables(spark, documents):
    rows = [(None, None, None), (1, "", "s"), (1, "", "s"), (2, "some words here", None), (3, "x " * 3000, "s")]
    for docs in (documents(rows), documents([])):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, SF_DIR)
            made.collect()
            if name != "sharding":
                assert made.schema.simpleString() == docs.schema.simpleString()


def test_registered_queries():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run
