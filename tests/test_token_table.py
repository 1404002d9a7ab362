"""The token table is written without a sort of all tokens of a task by class."""

from pyspark.sql import DataFrameWriter

from mailsift.sources import text as text_source

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def test_classes_have_their_files_open_at_once(spark, tmp_path, rows_of, monkeypatch):
    rows = [(i, 1 + i % 3 if i else None, 0, f"w{i}") for i in range(30)]
    tokens = spark.createDataFrame(rows, "doc_id long, class_id int, pos int, word string")
    before, during, write = spark.conf.get(WRITERS), [], DataFrameWriter.parquet

    def noted(self, *args, **options):
        during.append(int(spark.conf.get(WRITERS)))
        return write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    text_source.write_clean_tokens(tokens, str(tmp_path / "tokens"))
    assert during[0] >= 3 and spark.conf.get(WRITERS) == before
    found = text_source.read_clean_token_table(spark, str(tmp_path / "tokens"))
    assert rows_of(found.filter("class_id is not null"), "doc_id", "class_id", "pos", "word") == rows[1:]
    assert found.count() == 30
