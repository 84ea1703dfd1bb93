"""Text expressions shared by the operators that stay inside Spark SQL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: A word is a run of characters outside this class: space and the five ASCII control blanks.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
_GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of ``text`` in order; an empty array for null, empty or blank text."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(F.coalesce(bare, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(bare, _GAP))


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(F.coalesce(bare, F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(bare, _GAP))).cast("long")


def starts(size: Column | str, width: int) -> Column:
    """Positions 0 .. size - width of the windows of ``width`` elements; empty if there is none."""
    n = F.col(size) if isinstance(size, str) else size
    return F.when(n >= width, F.sequence(F.lit(0), n - F.lit(width))).otherwise(F.array().cast("array<int>"))
