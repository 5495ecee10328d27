"""Language identification by rank-order profiles.

A profile is a language's most frequent letter n-grams in rank order. A document's own most frequent n-grams are
compared with each profile by the out-of-place distance: the sum, over the document's n-grams, of how far
each lies from its place in the profile, with the profile length for n-grams that the profile lacks. The nearest
language wins.

N-grams have one to three characters. Letters are folded to lower case one code point at a time, runs of other
characters are one blank, and every text begins and ends with a blank.

Defined results: a null text, an empty one or one without a letter is ``und`` with score 0, and so is every text if
nothing was learned; equal distances go to the language that sorts first; equal counts are ranked by n-gram.
A null ``doc_id`` is not held out. Repeated rows are predicted each. Other columns of the input are ignored by
:func:`learn_profiles` and kept by :func:`identify`, which replaces columns of its own names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termfold.llm.arrays import counted, received, slices, with_text_columns

PROFILE_SIZE = 400
UNDETERMINED = "und"
#: n-gram counts that a task holds before it passes them on.
HELD_COUNTS = 2_000_000
#: Stands for all characters that are no letters; not 0, so that n-grams of different lengths have different keys.
BLANK = 1

Profiles = dict[str, list[int]]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@cache
def _folded() -> np.ndarray:
    """By code point: its lower-case letter, or the blank if it is no letter."""
    table = np.full(0x110000, BLANK, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            lower = char.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


def ngrams(text: str) -> np.ndarray:
    """Keys of all n-grams of one to three characters: 21 bits a character."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    letters = np.full(len(points) + 2, BLANK, np.int64)
    letters[1:-1] = _folded()[points]
    blank = letters == BLANK
    letters = letters[_kept(blank)]
    if len(letters) < 2:
        return np.zeros(0, np.int64)
    pairs = (letters[:-1] << 21) | letters[1:]
    triples = (pairs[:-1] << 21) | letters[2:]
    return np.concatenate((letters[letters != BLANK], pairs, triples))


def _kept(blank: np.ndarray) -> np.ndarray:
    kept = np.ones(len(blank), bool)
    kept[1:] = ~(blank[1:] & blank[:-1])
    return kept


def ranked(text: str | None, size: int) -> np.ndarray:
    """The most frequent n-grams of a text, most frequent first."""
    keys, counts = counted(ngrams(text)) if text else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return keys[np.lexsort((keys, -counts))[:size]]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}

    def passed_on() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            keys, counts = _merged(parts)
            yield pa.record_batch([pa.array([lang] * len(keys)), pa.array(keys), pa.array(counts)], ["lang", "ngram", "n"])
        held.clear()

    for batch in received(batches):
        for low, high, _, _ in slices(batch.column(0)):
            some = batch.slice(low, high - low)
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                parts = [counted(ngrams(text)) for text in texts]
                parts = [part for part in parts if len(part[0])]
                if parts:
                    held.setdefault(lang, []).append(_merged(parts))
            # What was added is merged in when it has grown as large as what it is added to.
            for lang, parts in held.items():
                if sum(len(keys) for keys, _ in parts[1:]) > len(parts[0][0]):
                    held[lang] = [_merged(parts)]
            if sum(len(keys) for parts in held.values() for keys, _ in parts) > HELD_COUNTS:
                yield from passed_on()
        batch = some = None
    yield from passed_on()


def learn_profiles(labelled: DataFrame, size: int = PROFILE_SIZE) -> Profiles:
    """Profiles of all languages in ``lang`` from the whole ``text`` of all rows; nulls teach nothing.

    Counts are summed by task first, so one language with most of the rows is no hot key. The driver receives
    ``size`` n-grams for each language.
    """
    rows = labelled.where("text is not null and lang is not null").select("text", F.col("lang").cast("string").alias("lang"))
    counts = rows.mapInArrow(_count_task, "lang string, ngram long, n long")
    totals = counts.groupBy("lang", "ngram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "ngram"))
    best = totals.withColumn("place", place).where(F.col("place") <= size)
    profiles: Profiles = {}
    for row in best.orderBy("lang", "place").collect():
        profiles.setdefault(row.lang, []).append(row.ngram)
    return profiles


class Nearest:
    """Out-of-place distances to all profiles at once."""

    def __init__(self, profiles: Profiles, size: int):
        self.langs = sorted(profiles)
        self.size = size
        self.keys = np.unique(np.concatenate([np.array(profiles[g], np.int64) for g in self.langs] or [np.zeros(0, np.int64)]))
        self.places = np.full((len(self.keys) + 1, len(self.langs)), -1, np.int64)
        for j, lang in enumerate(self.langs):
            self.places[np.searchsorted(self.keys, profiles[lang]), j] = np.arange(len(profiles[lang]))

    def __call__(self, text: str | None) -> tuple[str, float]:
        own = ranked(text, self.size)
        if not len(own) or not self.langs:
            return UNDETERMINED, 0.0
        at = np.searchsorted(self.keys, own)
        known = self.keys[np.minimum(at, len(self.keys) - 1)] == own
        places = self.places[np.where(known, at, len(self.keys))]
        away = np.where(places < 0, self.size, np.abs(places - np.arange(len(own))[:, None]))
        distances = away.sum(0)
        best = int(distances.argmin())
        return self.langs[best], 1.0 - float(distances[best]) / (self.size * len(own))


def identify(docs: DataFrame, profiles: Profiles, size: int = PROFILE_SIZE) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1, higher: nearer to the profile), whole texts."""

    def added(texts: pa.Array) -> list[pa.Array]:
        nearest = Nearest(profiles, size)
        found = [nearest(text) for low, high, _, _ in slices(texts) for text in texts.slice(low, high - low).to_pylist()]
        return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

    return with_text_columns(docs, added, "lang_pred string, score double")


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    profiles = learn_profiles(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
