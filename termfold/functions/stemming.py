"""Stemming as Arrow UDFs: every distinct word of a batch is stemmed once.

Words travel as blank-joined strings, one value per row and field, and are split
and joined again inside Arrow. That costs far less than moving arrays of words
between the JVM and Python, and needs no shuffle to find the distinct words.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from termfold.functions.porter import PorterStemmer

# Stems kept per Python worker; a bound, so that junk words cannot fill its memory.
REMEMBERED_WORDS = 1 << 18
# Bytes of lines that are split into words at a time: words, their places and stems take some ten times as much.
SLICE_BYTES = 4 << 20


@lru_cache(maxsize=None)
def remembering_stemmer(mode: str):
    return lru_cache(maxsize=REMEMBERED_WORDS)(PorterStemmer(mode).stem)


def stem_lines(lines: pa.Array, mode: str, dropped: frozenset[str]) -> pa.Array:
    """Stem the words of blank-separated lines, leaving out empty and dropped ones."""
    stem = remembering_stemmer(mode)
    words = pc.split_pattern(lines, " ")
    encoded = words.flatten().dictionary_encode()
    distinct = encoded.dictionary.to_pylist()
    # A dropped word becomes '' and takes its separator with it below.
    stems = pa.array([stem(w) + " " if w and w not in dropped else "" for w in distinct], pa.string())
    stemmed = pa.ListArray.from_arrays(line_bounds(words), stems.take(encoded.indices))
    return pc.utf8_rtrim(pc.binary_join(stemmed, ""), " ")


def slices(lines: pa.Array) -> list[pa.Array]:
    """The lines in runs of about ``SLICE_BYTES`` bytes; a longer line is one run."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(lines), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1).tolist(), len(lines)]
    return [lines.slice(start, end - start) for start, end in zip(cuts, cuts[1:])]


def line_bounds(words: pa.ListArray) -> pa.Array:
    """Offsets of the lists in the flattened array; a null line is an empty list."""
    lengths = pc.fill_null(pc.list_value_length(words), 0)
    return pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(lengths).cast(pa.int32())])


def stem_text(text: Column, mode: str = "extended", dropped: Iterable[str] = ()) -> Column:
    """Blank-separated words to blank-separated stems, order and repetitions kept."""
    leave_out = frozenset(dropped)

    @F.arrow_udf(StringType())
    def stem_column(lines: pa.Array) -> pa.Array:
        return pa.concat_arrays([stem_lines(some, mode, leave_out) for some in slices(lines)])

    return stem_column(text)


def stem_words(words: Column, mode: str = "extended") -> Column:
    """Array of words without blanks to array of stems; null gives ``[]``."""
    joined = F.coalesce(F.array_join(words, " "), F.lit(""))
    return F.array_remove(F.split(stem_text(joined, mode), " "), "")
