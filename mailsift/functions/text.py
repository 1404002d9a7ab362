"""Text expressions. Every function maps a string column to a column and runs inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# --- fixed values -----------------------------------------------------------------------------
# Mail header lines to drop: a line is dropped when it starts with one of these.
HEADER_PREFIXES = (
    "Xref",
    "Path",
    "From",
    "Message-ID",
    "Date",
    "Article-I.D.",
    "References",
    "Lines",
    "Expires",
    "Last-update",
)

# The English stop words that Lucene 5 ships as its default set.
ENGLISH_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
    "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these", "they",
    "this", "to", "was", "will", "with",
)

# Line ends as java.util.Scanner sees them.
LINE_END = "\r\n|[\n\r\u2028\u2029\u0085]"

# ----------------------------------------------------------------------------------------------


def lines(text: Column) -> Column:
    """The lines of a text, without an empty one after a final line end."""
    ends_in = reduce(lambda a, b: a | b, [text.endswith(end) for end in "\n\r\u2028\u2029\u0085"])
    body = (
        F.when(text.endswith("\r\n"), F.left(text, F.length(text) - 2))
        .when(ends_in, F.left(text, F.length(text) - 1))
        .otherwise(text)
    )
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, LINE_END))


def is_header(line: Column) -> Column:
    """True for a line that starts with one of the mail header prefixes (case matters)."""
    return reduce(lambda a, b: a | b, [line.startswith(p) for p in HEADER_PREFIXES])


def without_headers(text: Column) -> Column:
    """The text with header lines blanked, wherever in the message they stand."""
    starts = "|".join(p.replace(".", "\\.") for p in HEADER_PREFIXES)
    return F.regexp_replace(text, f"(?m)^(?:{starts}).*$", "")


def lower_letters(text: Column) -> Column:
    """Lower case letter by letter, so that the result of one letter never depends on its
    neighbours (final sigma) and never becomes two (dotted capital I)."""
    return F.lower(F.translate(text, "İΣ", "iσ"))


def letter_tokens(text: Column) -> Column:
    """Maximal runs of letters, in lower case."""
    return F.regexp_extract_all(lower_letters(text), F.lit("\\p{L}+"), F.lit(0))


def whitespace_tokens(text: Column) -> Column:
    """Non-empty pieces between runs of space, tab, line feed, carriage return or form feed."""
    return F.filter(F.split(text, "[ \t\n\r\f]+"), lambda w: w != "")


def regex_tokens(text: Column) -> Column:
    """Lower-cased pieces between single white-space characters, empty pieces dropped: what
    ``RegexTokenizer(pattern="\\\\s")`` yields, as an expression."""
    return F.filter(F.split(F.lower(text), "\\s"), lambda w: w != "")


def split_keeping_inner(text: Column, delimiter: str) -> Column:
    """Split on one character; empty pieces stay inside the text and go at its end.

    The empty text is one empty piece, a text of delimiters only has none.
    """
    body = F.rtrim(text, F.lit(delimiter))
    return F.when((text != "") & (body == ""), F.array().cast("array<string>")).otherwise(
        F.split(body, delimiter)
    )


def newline_tokens(text: Column) -> Column:
    """One token per line feed separated piece."""
    return split_keeping_inner(text, "\n")


def space_tokens(text: Column) -> Column:
    """One token per space separated piece."""
    return split_keeping_inner(text, " ")
