"""Operators for large text corpora: duplicates, language, quality, licences, mixing, tokens and URLs.

Every operator takes a DataFrame plus column names, selects what it needs under names of its own (so
extra columns with clashing names do no harm) and returns a DataFrame keyed by the identifier column.
"""
