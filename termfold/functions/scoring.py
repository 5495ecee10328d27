"""Postings and scores as column expressions.

A posting is ``struct<doc_id, title, text, categories, infobox, external_links>``,
its string form ``id:title-text-categories-infobox-external_links``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from termfold import values as v

COUNTS = [field.lower() for field in v.FIELDS]


def posting() -> Column:
    """Posting of a term-document row."""
    counts = [F.col(field).alias(field.lower()) for field in v.FIELDS]
    return F.struct(F.col("Id").alias("doc_id"), *counts)


def posting_string(posting: Column) -> Column:
    counts = F.concat_ws(v.COUNT_SEPARATOR, *[posting[name].cast("string") for name in COUNTS])
    return F.concat_ws(v.ID_SEPARATOR, posting["doc_id"], counts)


def posting_list_string(postings: Column) -> Column:
    return F.array_join(F.transform(postings, posting_string), v.POSTING_SEPARATOR)


def parse_posting(text: Column) -> Column:
    """Posting struct of one string form."""
    parts = F.split(text, v.ID_SEPARATOR)
    counts = F.split(parts[1], v.COUNT_SEPARATOR)
    fields = [counts[i].cast("long").alias(name) for i, name in enumerate(COUNTS)]
    return F.struct(parts[0].alias("doc_id"), *fields)


def parse_posting_list(text: Column) -> Column:
    return F.transform(F.split(text, v.POSTING_SEPARATOR), parse_posting)


def posting_score(posting: Column, weights: dict[str, int] = v.WEIGHTS) -> Column:
    """Weighted sum of the field counts plus a base score for the hit itself."""
    score = F.lit(weights["base"]).cast("long")
    for name in COUNTS:
        score = score + posting[name] * weights[name]
    return score
