"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Runs of letters and digits, and what lies between them (SQL INITCAP's words).
_PIECES = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def full_name(first: Column, last: Column) -> Column:
    """first || ' ' || last (NULL if either part is NULL, like SQL ``||``)."""
    return F.concat(first, F.lit(" "), last)


def title_case(s: Column) -> Column:
    """SQL INITCAP: upper-case the first letter of every word, lower-case the rest.

    Unlike Spark's ``initcap`` (which only breaks on spaces), a word starts
    after any non-alphanumeric character: ``o'brien-smith`` -> ``O'Brien-Smith``.
    One regex pass cuts the string into words and the rest; then only the few
    pieces are touched, all in JVM expressions.
    """
    pieces = F.regexp_extract_all(s, F.lit(_PIECES), F.lit(0))
    return F.array_join(F.transform(
        pieces, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.lower(F.substr(p, F.lit(2))))), "")
