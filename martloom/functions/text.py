"""Text expressions: splitting, joining, number parsing, place names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pieces(text: Column, separator: str = ":+") -> Column:
    """Split on a regular expression; the first piece has index 0."""
    return F.split(text, separator)


def decimal_comma(text: Column) -> Column:
    """Parse a number written with a decimal comma."""
    return F.regexp_replace(text, ",", ".").cast("double")


def place_name(text: Column) -> Column:
    """Canonical spelling of a place: lower case, single blanks, no punctuation."""
    cleaned = F.regexp_replace(F.lower(text), r"[^\p{L}\p{Nd}]+", " ")
    return F.trim(cleaned)


def words(text: Column) -> Column:
    """Lower-case words of a whole text, in order: runs of letters of any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1))
