"""Messages to tokens.

``messages`` has ``doc_id`` and ``text``; further columns (class, path, …) are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from mailsift.functions import text as T
from mailsift.session import shuffle_width


def by_document(messages: DataFrame) -> DataFrame:
    """Spread messages over the cluster by ``doc_id`` while they are still compact text.

    Tokens exploded from the result stay where their document is, so counts per (document, word),
    document lengths and distinct documents need no exchange of the much larger token rows. The
    partition count is given explicitly because tokenising is bound by CPU, not by the bytes that
    partition coalescing looks at.
    """
    return messages.repartition(shuffle_width(messages.sparkSession), "doc_id")


def kept_lines(messages: DataFrame) -> DataFrame:
    """(…, line_no, line): the lines of each message that are not mail headers."""
    carried = [c for c in messages.columns if c != "text"]
    exploded = messages.select(*carried, F.posexplode(T.lines(F.col("text"))).alias("line_no", "line"))
    return exploded.filter(~T.is_header(F.col("line")))


def clean_tokens(
    messages: DataFrame,
    stop_words: DataFrame | None = None,
    english_stop_words: bool = True,
    drop_headers: bool = True,
) -> DataFrame:
    """(…, pos, word): lower-case letter runs without header lines and stop words.

    ``pos`` numbers the letter runs of a message from 0; removed stop words leave gaps.
    ``stop_words`` is a table with a ``word`` column, compared without case, on top of the
    built-in English list.
    """
    carried = [c for c in messages.columns if c != "text"]
    body = T.without_headers(F.col("text")) if drop_headers else F.col("text")
    tokens = messages.select(*carried, F.posexplode(T.letter_tokens(body)).alias("pos", "word"))
    if english_stop_words:
        tokens = tokens.filter(~F.col("word").isin(*T.ENGLISH_STOP_WORDS))
    if stop_words is not None:
        listed = stop_words.select(T.lower_letters(F.col("word")).alias("word")).distinct()
        tokens = tokens.join(listed, "word", "left_anti").select(*carried, "pos", "word")
    return tokens


def kept_words(text: Column) -> Column:
    """The clean tokens of a text as an array: no headers, no English stop words."""
    return F.filter(T.letter_tokens(T.without_headers(text)), lambda w: ~w.isin(*T.ENGLISH_STOP_WORDS))


def clean_text(messages: DataFrame) -> DataFrame:
    """The messages with ``text`` replaced by its clean tokens, one per line. Moves no row."""
    return messages.withColumn("text", F.concat_ws("\n", kept_words(F.col("text"))))


def counted_clean_text(messages: DataFrame) -> tuple[DataFrame, Observation]:
    """``clean_text``, and what the first action on it meets: messages, header lines, letter runs outside of them,
    stop words among these, words that stay, and messages left without any. Counted in the same pass; a null text
    is a message without words."""
    text = F.col("text")
    n_lines = F.size(F.filter(T.lines(text), T.is_header))
    n_runs, n_kept = F.size(T.letter_tokens(T.without_headers(text))), F.size(kept_words(text))
    sized = messages.withColumns({"_headers": n_lines, "_runs": n_runs, "_kept": n_kept})
    sized = sized.fillna(0, ["_headers", "_runs", "_kept"])
    counters = Observation()
    total = lambda c: F.coalesce(F.sum(F.greatest(c, F.lit(0))), F.lit(0))
    seen = sized.observe(
        counters,
        F.count("*").alias("messages"),
        total(F.col("_headers")).alias("header_lines"),
        total(F.col("_runs")).alias("letter_runs"),
        total(F.col("_runs") - F.col("_kept")).alias("stop_words"),
        total(F.col("_kept")).alias("words"),
        F.count_if(F.col("_kept") <= 0).alias("empty_messages"),
    )
    return clean_text(seen.drop("_headers", "_runs", "_kept")), counters


def marked_tokens(messages: DataFrame) -> DataFrame:
    """(…, word, is_first): the clean tokens, the first one of each message marked. Moves no row."""
    carried = [c for c in messages.columns if c != "text"]
    tokens = messages.select(*carried, F.posexplode(kept_words(F.col("text"))).alias("_at", "word"))
    return tokens.select(*carried, "word", (F.col("_at") == 0).alias("is_first"))


def split_tokens(messages: DataFrame, splitter) -> DataFrame:
    """(…, pos, word) with one of the splitting functions of :mod:`mailsift.functions.text`."""
    carried = [c for c in messages.columns if c != "text"]
    return messages.select(*carried, F.posexplode(splitter(F.col("text"))).alias("pos", "word"))


def token_counts(messages: DataFrame) -> DataFrame:
    """(doc_id, n_tokens) for every message, 0 where cleaning leaves nothing. Moves no row."""
    n_tokens = F.coalesce(F.size(kept_words(F.col("text"))), F.lit(0)).cast("bigint")
    return messages.select("doc_id", F.greatest(n_tokens, F.lit(0)).alias("n_tokens"))


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """(word, n) over space separated lines, most frequent first, then by word."""
    words = lines.select(F.explode(T.space_tokens(F.col(column))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word")
