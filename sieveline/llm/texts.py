"""Column expressions over texts that several operators share. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"


def text_of(column: str | Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """The runs of characters other than blanks, in order; none for an empty text."""
    return F.array_remove(F.split(text, BLANK_RUN), "")


def word_count(text: Column) -> Column:
    """How many words :func:`words_of` would give, without keeping them."""
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def count_of(text: Column, characters: str) -> Column:
    """How often any of the characters occurs."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it.

    A lambda variable is the only name a column expression can give to an intermediate result; used
    without it, an array that a lambda refers to would be computed anew for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def spans_digest(spans: Column) -> Column:
    """Lower-case hex SHA-256 of an array of span strings, joined by commas."""
    return F.sha2(F.array_join(spans, ",").cast("binary"), 256)
