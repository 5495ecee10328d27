"""Tokens and stop words as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from termfold import values as v


def tokenize(text: Column) -> Column:
    """Words between single blanks; empty ones are dropped."""
    return F.array_remove(F.split(text, " "), "")


def without(words: Column, stop_words: list[str]) -> Column:
    """Drop stop words from an array, keeping order and repetitions."""
    return F.filter(words, lambda word: ~word.isin(stop_words))


def without_index_stop_words(words: Column) -> Column:
    return without(words, v.INDEX_STOP_WORDS)


def query_words(query: Column) -> Column:
    """ASCII letter and digit runs of the lower-cased query, minus the query stop words."""
    found = F.regexp_extract_all(F.lower(query), F.lit(v.QUERY_WORD), F.lit(0))
    return without(found, v.QUERY_STOP_WORDS)
