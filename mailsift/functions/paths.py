"""Document, class and directory names from file paths, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def file_name(path: Column) -> Column:
    """The last segment of a path."""
    return F.element_at(F.split(path, "/"), -1)


def directory_name(path: Column) -> Column:
    """The segment before the last one; null for a path without a directory."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def document_of(name: Column) -> Column:
    """``<document>-<class>``: the part before the first dash."""
    return F.substring_index(name, "-", 1)


def class_of(name: Column) -> Column:
    """``<document>-<class>``: the part between the first and second dash, null without a dash."""
    return F.try_element_at(F.split(name, "-"), F.lit(2))


def class_at_end_of(name: Column) -> Column:
    """``<document>-<class>``: the part after the last dash. Differs from :func:`class_of` when
    the document name itself has dashes."""
    return F.element_at(F.split(name, "-"), -1)


def document_before_class(name: Column) -> Column:
    """``<document>-<class>``: the part before the last dash."""
    return F.left(name, F.char_length(name) - F.char_length(class_at_end_of(name)) - 1)


def clean_name(name: Column, class_id: Column) -> Column:
    """The ``<document>-<class>`` name of a cleaned message; a class that was not found is written
    as the word ``null``."""
    return F.concat(name, F.lit("-"), F.coalesce(class_id.cast("string"), F.lit("null")))
