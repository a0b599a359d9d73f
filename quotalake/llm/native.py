"""Column expressions shared by the native (DataFrame/SQL only) operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything that is neither an ASCII digit or lower-case letter nor non-ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; ``lower`` does that by itself for an ASCII text."""
    return (F.when(F.length(text) == F.octet_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def words(lowered: Column) -> Column:
    """Array of the words of an already lower-cased text (empty for an empty text)."""
    return F.array_remove(F.split(lowered, SEPARATORS), "")
