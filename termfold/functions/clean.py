"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from termfold import values as v


def normalize_case(text: Column) -> Column:
    """Lower-case; a page without a body counts as an empty one."""
    return F.lower(F.coalesce(text, F.lit("")))


def clean_body_sequential(text: Column) -> Column:
    """Five replacements one after the other; only punctuation leaves a blank."""
    text = F.regexp_replace(text, v.CITE, "")
    text = F.regexp_replace(text, v.PUNCTUATION, " ")
    text = F.regexp_replace(text, v.FILE_LINK, "")
    text = F.regexp_replace(text, v.TAG, "")
    return F.regexp_replace(text, v.NON_ASCII, "")


def clean_body_single_pass(text: Column) -> Column:
    """The same five patterns in one scan; every match leaves a blank."""
    any_of = "|".join([v.CITE, v.PUNCTUATION, v.FILE_LINK, v.TAG, v.NON_ASCII])
    return F.regexp_replace(text, any_of, " ")


CLEANERS = {"sequential": clean_body_sequential, "single_pass": clean_body_single_pass}


def strip_junk(text: Column) -> Column:
    """Markup characters and line ends become blanks, each its own."""
    return F.regexp_replace(F.regexp_replace(text, v.JUNK, " "), r"\n", " ")


def strip_title_junk(title: Column) -> Column:
    return F.regexp_replace(title, v.JUNK, " ")


def clean_categories(categories: Column) -> Column:
    """Array of names: markup characters vanish, so ``a-b|c`` is one word ``abc``."""
    return F.transform(categories, lambda name: F.trim(F.regexp_replace(name, v.JUNK, "")))


def clean_infobox(infobox: Column) -> Column:
    return F.regexp_replace(infobox, v.NOT_WORD_CHARACTER, " ")


def squeeze_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def squeeze_junk(text: Column) -> Column:
    """``strip_junk`` and ``squeeze_whitespace`` in one scan, with the same result."""
    junk_or_space = v.JUNK.removesuffix("]") + r"\s]+"
    return F.trim(F.regexp_replace(text, junk_or_space, " "))


def squeeze_infobox(infobox: Column) -> Column:
    """``clean_infobox`` and ``squeeze_whitespace`` in one scan, with the same result."""
    return F.trim(F.regexp_replace(infobox, f"{v.NOT_WORD_CHARACTER}+", " "))


def strip(text: Column, characters: str = v.STRIPPED) -> Column:
    return F.trim(text, F.lit(characters))
