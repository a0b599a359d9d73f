"""Corpus operators for training-data preparation (quality, dedup, packing, ...).

Nothing outside this subpackage imports it.  Every module documents what it
does with nulls, empty and very long texts, ties, repeated rows, empty tables
and extra columns.  ``queries.py`` holds the registered ``opN_*`` queries.
"""
