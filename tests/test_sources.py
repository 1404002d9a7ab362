import os
import time

import pytest
from pyspark.sql import functions as F

from mailsift.functions.features import FEATURES_TYPE, as_ml_vector
from mailsift.session import dropped, stored
from mailsift.sources import files, sparse, tables, text as text_source


@pytest.fixture
def corpus(tmp_path):
    files = {"alt.atheism/49960": "Hello\nworld\n", "sci.space/1-2": "Up\r\n\n", "sci.space/empty": ""}
    for name, text in files.items():
        path = tmp_path / "corpus" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, newline="")
    return str(tmp_path / "corpus")


def test_corpus_of_class_directories(spark, corpus, rows_of):
    assert rows_of(text_source.read_corpus(spark, corpus)) == [
        ("alt.atheism/49960", "alt.atheism", "Hello\nworld\n"),
        ("sci.space/1-2", "sci.space", "Up\r\n\n"),
        ("sci.space/empty", "sci.space", ""),
    ]


def test_lines_of_several_paths(spark, corpus):
    lines = text_source.read_lines(spark, f"{corpus}/alt.atheism", f"{corpus}/sci.space")
    assert sorted(r.value for r in lines.collect()) == ["", "Hello", "Up", "world"]


def test_clean_token_files(spark, tmp_path, rows_of):
    (tmp_path / "9-8-7").write_text("one\ntwo\n")
    (tmp_path / "5-4").write_text(" three \n")
    (tmp_path / "5-3").write_text("four")
    found = text_source.read_clean_tokens(spark, str(tmp_path))
    assert rows_of(found) == [
        ("5-3", "5", 3, "four"), ("5-4", "5", 4, "three"), ("9-8-7", "9-8", 7, "one"), ("9-8-7", "9-8", 7, "two"),
    ]


def test_stop_words(spark, tmp_path, rows_of):
    (tmp_path / "stop").write_text("the  of\nThe\tof\n\n")
    assert rows_of(text_source.read_stop_words(spark, str(tmp_path / "stop"))) == [("The",), ("of",), ("the",)]


def test_pairs_replace_and_keep_odd_words(spark, tmp_path, rows_of):
    path = str(tmp_path / "dictionary")
    for rows in ([("x", 1)], [('"quoted"', 1), ("back\\slash", 2), ("'", 3)]):
        tables.write_dictionary(spark.createDataFrame(rows, "word string, feature_id int"), path)
        assert rows_of(tables.read_dictionary(spark, path)) == sorted(rows)


def test_bad_lines_are_data(spark, tmp_path, rows_of):
    (tmp_path / "pairs").write_text("word\t1\nbroken\nnumber\tx\na\tb\t3\n\tempty\nlast\t2\n")
    path = str(tmp_path / "pairs")
    assert rows_of(tables.read_dictionary(spark, path)) == [("last", 2), ("word", 1)]
    assert rows_of(tables.read_dictionary(spark, path), "word") == [("last",), ("word",)]
    rejects = tables.read_rejects(spark, path, tables.DICTIONARY)
    assert rows_of(rejects) == [("\tempty",), ("a\tb\t3",), ("broken",), ("number\tx",)]
    pairs, counters = tables.read_counted_pairs(spark, path, tables.DICTIONARY)
    assert len(pairs.collect()) == 2
    assert counters.get == {"n_rows": 2, "n_rejects": 4}


def test_whole_files_in_tasks_of_equal_bytes(tmp_path, monkeypatch):
    monkeypatch.setattr(files, "OPENING_BYTES", 10)
    for i in range(12):
        (tmp_path / f"f{i:02}").write_text("x" * (25 * (i % 3)))
    (tmp_path / "_SUCCESS").write_text("")
    reader = files.WholeFileReader({"path": f"file://{tmp_path}", "partitionBytes": "100"})
    parts = reader.partitions()
    assert sorted(p for part in parts for p in part.paths) == sorted(str(f) for f in tmp_path.glob("f*"))
    assert len(parts) == 4
    rows = [r for part in parts for batch in reader.read(part) for r in batch.to_pylist()]
    assert {r["path"][-3:]: len(r["text"]) for r in rows} == {f"f{i:02}": 25 * (i % 3) for i in range(12)}


def test_a_lost_attempt_leaves_no_file(tmp_path):
    root = tmp_path / "out"
    writer = files.WholeFileWriter({"path": f"file://{root}"})
    rows = [{"path": "a/1", "text": "one"}, {"path": "a/2", "text": None}, {"path": "b/1", "text": "two"}]

    def lost():
        yield rows[0]
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(lost())
    assert not (root / "a").exists()
    writer.commit([writer.write(iter(rows[:2])), writer.write(iter(rows[2:]))])
    found = {str(f.relative_to(root)): f.read_text() for f in root.rglob("*") if f.is_file()}
    assert found == {"a/1": "one", "a/2": "", "b/1": "two"}
    assert not (root / "_temporary").exists()
    with pytest.raises(ValueError, match="two rows have the path"):
        writer.commit([writer.write(iter(rows[:1]))])
    with pytest.raises(ValueError, match="needs a path"):
        writer.write(iter([{"path": None, "text": "x"}]))


def test_a_failed_write_is_taken_back(spark, tmp_path):
    root = tmp_path / "out"
    rows = spark.createDataFrame([("a/1", "x"), (None, "y")], "path string, text string")
    with pytest.raises(Exception, match="needs a path"):
        text_source.write_files(rows, str(root))
    assert not [f for f in root.rglob("*") if f.is_file()]
    text_source.write_files(rows.limit(0), str(root))
    assert text_source.read_files(spark, str(root)).count() == 0


def test_prediction_lines(spark, tmp_path, rows_of):
    path = str(tmp_path / "predictions")
    rows = spark.createDataFrame([("a", 1, 2), ("b", 2, None)], "doc_id string, label int, prediction int")
    tables.write_predictions(rows, path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["a-1\t2", "b-2\tNo find"]
    assert tables.read_predictions(spark, path).orderBy("doc_id").collect() == rows.collect()


def test_names_with_dashes_and_colons(spark, tmp_path, rows_of):
    names = ["comp.os.ms-windows.misc/9994", "my-file", "a:b-c:d-"]
    predictions = spark.createDataFrame([(n, 3, 2) for n in names], "doc_id string, label int, prediction int")
    tables.write_predictions(predictions, str(tmp_path / "p"))
    assert rows_of(tables.read_predictions(spark, str(tmp_path / "p"))) == rows_of(predictions)
    weights = spark.createDataFrame([(n, 3, "word", 0.5) for n in names], "doc_id string, class_id int, word string, weight double")
    tables.write_tfidf(weights, str(tmp_path / "w"))
    assert rows_of(tables.read_tfidf(spark, str(tmp_path / "w"))) == rows_of(weights)


def test_sparse_line_with_unsorted_ids(spark, tmp_path):
    (tmp_path / "lines").write_text("9 3620:0.2 963:0.26 439:0.156\n4\n")
    rows = sparse.read_sparse_lines(spark, str(tmp_path / "lines")).orderBy("label").collect()
    assert (rows[0].label, rows[0].features) == (4, [])
    assert rows[1].label == 9
    assert [tuple(f) for f in rows[1].features] == [(439, 0.156), (963, 0.26), (3620, 0.2)]


def test_sparse_lines_round_trip(spark, tmp_path, rows_of):
    vectors = spark.createDataFrame([(1, [(2, 0.5), (7, 1e-7)]), (2, [])], f"label int, features {FEATURES_TYPE}")
    path = str(tmp_path / "sparse")
    sparse.write_sparse_lines(vectors, path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["1 2:0.5 7:1.0E-7", "2"]
    assert rows_of(sparse.read_sparse_lines(spark, path)) == rows_of(vectors)


def test_libsvm_round_trip(spark, tmp_path):
    vectors = spark.createDataFrame([(1.0, [(2, 0.5), (7, 3.0)])], f"label double, features {FEATURES_TYPE}")
    path = str(tmp_path / "libsvm")
    rows = vectors.select("label", as_ml_vector(F.col("features"), F.lit(8)).alias("features"))
    sparse.write_libsvm(rows, path)
    assert [r.value for r in spark.read.text(path).collect()] == ["1.0 2:0.5 7:3.0"]
    assert sparse.read_libsvm(spark, path, size=8).collect() == rows.collect()


def test_many_small_clean_files_are_one_task(spark, tmp_path):
    for i in range(400):
        (tmp_path / f"m-{i}-1").write_text("one\n\ntwo words\r\n" if i % 2 else "")
    found = text_source.read_clean_tokens(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == 1
    assert sorted({(r.doc_id, r.document, r.class_id, r.word) for r in found.collect() if r.doc_id == "m-7-1"}) == [
        ("m-7-1", "m-7", 1, word) for word in ("one", "two", "words")
    ]
    both = text_source.read_clean_tokens(spark, str(tmp_path / "m-1-1"), str(tmp_path / "m-3-1"))
    assert both.count() == 6
    with pytest.raises(Exception, match="absent"):
        text_source.read_clean_tokens(spark, str(tmp_path / "absent")).count()


def test_compressed_lines_are_read_back(spark, tmp_path, rows_of):
    vectors = spark.createDataFrame([(2, [(3, 0.5), (1, 0.25)]), (1, [])], f"label int, features {FEATURES_TYPE}")
    sparse.write_sparse_lines(vectors, f"file://{tmp_path}/lines", "gzip")
    assert sparse.read_sparse_lines(spark, f"file://{tmp_path}/lines").orderBy("label").collect() == [(1, []), (2, [(1, 0.25), (3, 0.5)])]
    weights = spark.createDataFrame([("a-b", 1, "word", 0.1 + 0.2)], "doc_id string, class_id int, word string, weight double")
    tables.write_tfidf(weights, f"file://{tmp_path}/weights", "gzip")
    assert rows_of(tables.read_tfidf(spark, f"file://{tmp_path}/weights")) == [("a-b", 1, "word", 0.1 + 0.2)]
    written = [f.name for kind in ("lines", "weights") for f in (tmp_path / kind).glob("part-*")]
    assert written and all(name.endswith(".gz") for name in written)


def test_stored_tables_leave_no_shuffle_files_and_can_be_dropped(spark):
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    table = stored(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "count"))
    deadline = time.time() + 10
    while tracker.shuffleStatuses().size() > before and time.time() < deadline:
        time.sleep(0.1)
    assert tracker.shuffleStatuses().size() <= before
    assert table.count() == 7
    path = table._kept_at.removeprefix("file:")
    assert os.path.isdir(path.replace("//", "/"))
    dropped(table)
    assert not os.path.exists(path.replace("//", "/"))
