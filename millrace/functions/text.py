"""Tokenising: the three word-splitting dialects, and characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.columns import ColumnLike, _col

# What separates words in each dialect.
SEPARATORS = {
    "space": " ",
    "whitespace": "[ \\t\\n\\r\\f]+",
    "pig": "[ \",()*]+",
}


def tokens(c: ColumnLike, mode: str = "space") -> Column:
    """The pieces between separators, the empty ones included.

    Empty words count in the ``space`` dialect; the other two drop them once exploded.
    """
    return F.split(_col(c), SEPARATORS[mode])


def characters(c: ColumnLike) -> Column:
    """The characters of a line, spaces left out."""
    return F.split(F.replace(_col(c), F.lit(" "), F.lit("")), "")


def word_tokens(c: ColumnLike) -> Column:
    """Lower-cased pieces between characters that belong to no word, the empty ones included."""
    return F.split(F.lower(_col(c)), "\\W")
