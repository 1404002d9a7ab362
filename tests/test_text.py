from pyspark.sql import functions as F

from mailsift.functions import paths as P, text as T
from mailsift.operators import tokens as K


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "text string").select(expression(F.col("text"))).collect()[0][0]


def test_letter_tokens_are_lower_case_letter_runs(spark):
    assert one(spark, "Don't PANIC, 42 Ñandú-x\nÜber", T.letter_tokens) == ["don", "t", "panic", "ñandú", "x", "über"]


def test_letters_are_lowered_one_by_one(spark):
    assert one(spark, "İZMİR ΟΔΟΣ", T.letter_tokens) == ["izmir", "οδοσ"]


def test_long_runs_are_cut(spark):
    assert [len(w) for w in one(spark, "a" * 600, T.letter_tokens)] == [600]


def test_empty_text_has_no_tokens(spark):
    for text in ("", "  \n", "42 !"):
        assert one(spark, text, T.letter_tokens) == []


def test_header_lines_are_dropped_anywhere_and_by_prefix_only(spark):
    text = "From: me\r\nSubject: hi\nPathetic body\n Date\nfrom here Lines: 3\nend"
    body = one(spark, text, lambda c: T.letter_tokens(T.without_headers(c)))
    assert body == ["subject", "hi", "date", "from", "here", "end"]
    messages = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    lines = [(r.line_no, r.line) for r in K.kept_lines(messages).orderBy("line_no").collect()]
    assert lines == [(1, "Subject: hi"), (3, " Date"), (4, "from here"), (6, "end")]


def test_lines(spark):
    assert one(spark, "", T.lines) == []
    assert one(spark, "a\n", T.lines) == ["a"]
    assert one(spark, "a\r\n\nb", T.lines) == ["a", "", "b"]


def test_split_drops_only_trailing_empties(spark):
    assert one(spark, "a\n\nb\n\n", T.newline_tokens) == ["a", "", "b"]
    assert one(spark, "", T.newline_tokens) == [""]
    assert one(spark, "\n\n", T.newline_tokens) == []
    assert one(spark, "  a  b ", T.space_tokens) == ["", "", "a", "", "b"]


def test_regex_and_whitespace_tokens(spark):
    assert one(spark, " A\tb\x0bC  d ", T.regex_tokens) == ["a", "b", "c", "d"]
    assert one(spark, " A\tb\x0bC  d ", T.whitespace_tokens) == ["A", "b\x0bC", "d"]


def test_clean_tokens_with_custom_stop_words(spark):
    messages = spark.createDataFrame([(1, "The quick Fox and the Dog")], "doc_id bigint, text string")
    stop = spark.createDataFrame([("FOX",)], "word string")
    rows = K.clean_tokens(messages, stop).orderBy("pos").collect()
    assert [(r.pos, r.word) for r in rows] == [(1, "quick"), (5, "dog")]
    kept = K.clean_tokens(messages, english_stop_words=False)
    assert kept.count() == 6


def test_clean_text_equals_clean_tokens(spark):
    messages = spark.createDataFrame([(1, "From x\nThe quick Fox\n"), (2, "")], "doc_id bigint, text string")
    assert [r.text for r in K.clean_text(messages).orderBy("doc_id").collect()] == ["quick\nfox", ""]


def test_token_counts_include_empty_messages(spark, rows_of):
    messages = spark.createDataFrame([(1, "the a"), (2, "some words")], "doc_id bigint, text string")
    assert rows_of(K.token_counts(messages)) == [(1, 0), (2, 2)]


def test_names(spark):
    path = "hdfs://host/mail/rec.autos/my-file-7"
    name = P.file_name(F.lit(path))
    row = spark.range(1).select(
        name.alias("name"),
        P.directory_name(F.lit(path)).alias("directory"),
        P.directory_name(F.lit("file")).alias("none"),
        P.document_of(name).alias("document"),
        P.class_of(name).alias("second"),
        P.class_at_end_of(name).alias("last"),
        P.clean_name(F.lit("f"), F.lit(None).cast("int")).alias("unknown"),
    ).collect()[0]
    assert tuple(row) == ("my-file-7", "rec.autos", None, "my", "file", "7", "f-null")
