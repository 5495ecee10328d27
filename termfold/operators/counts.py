"""Term counts per document and field."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from termfold import values as v
from termfold.functions import stemming
from termfold.session import ship_package, stored

# Words that are counted at a time, in whole documents.
WORDS_TOGETHER = 1 << 19


def term_frequency(words: DataFrame, field: str) -> DataFrame:
    """``(Id, Word, <field>)``: how often a word occurs in one field of a document.

    ``explode`` would have the optimizer test the array's size first, below all projections: there the field's
    expressions take the place of its name, as often as they name each other. An outer one has no such test, and the
    null it gives for an empty field goes with the empty words.
    """
    return (
        words.select("Id", F.explode_outer(field).alias("Word"))
        .filter(F.col("Word") != "")
        .groupBy("Id", "Word")
        .agg(F.count("Word").alias(field))
    )


def merge_term_frequencies(frequencies: list[DataFrame]) -> DataFrame:
    """Full outer merge of per-field counts on document and word, absent counts 0.

    A frequency has one row per document and word, so rows set under each other and added up are the outer join's. A
    chain of outer joins would deal out and sort the rows merged so far again for every further field.
    """
    under_each_other = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frequencies)
    return under_each_other.groupBy("Id", "Word").agg(*[F.sum(name).alias(name) for name in v.FIELDS]).fillna(0, v.FIELDS)


def count_words(rows: pa.RecordBatch, stop_words: pa.Array) -> pa.RecordBatch:
    """``(Id, Word, <fields>)``: the words of each row of ``(Id, <fields>)`` with their counts in its fields."""
    fields = [rows.column(name) for name in v.FIELDS]
    encoded = pa.concat_arrays([pc.list_flatten(words) for words in fields]).dictionary_encode()
    row = np.concatenate([pc.list_parent_indices(words).to_numpy() for words in fields]).astype(np.int64)
    field = np.repeat(np.arange(len(fields)), [pc.sum(pc.list_value_length(words)).as_py() or 0 for words in fields])
    left_out = pc.or_(pc.is_in(encoded.dictionary, stop_words), pc.equal(encoded.dictionary, ""))
    counted = pc.invert(pc.take(pc.fill_null(left_out, True), encoded.indices)).fill_null(False).to_numpy(zero_copy_only=False)
    size = max(len(encoded.dictionary), 1)
    code = encoded.indices.fill_null(0).to_numpy().astype(np.int64)[counted]
    met, place = np.unique(row[counted] * size + code, return_inverse=True)
    counts = np.bincount(place * len(fields) + field[counted], minlength=len(met) * len(fields)).reshape(-1, len(fields))
    columns = [rows.column("Id").take(pa.array(met // size)), encoded.dictionary.take(pa.array(met % size))]
    return pa.RecordBatch.from_arrays(
        [*columns, *[pa.array(np.ascontiguousarray(counts[:, i]), pa.int64()) for i in range(len(fields))]],
        names=["Id", "Word", *v.FIELDS],
    )


def runs_of_rows(rows: pa.RecordBatch) -> list[pa.RecordBatch]:
    """The rows in runs of about ``WORDS_TOGETHER`` words; a longer row is one run."""
    lengths = sum(pc.fill_null(pc.list_value_length(rows.column(name)), 0).to_numpy().astype(np.int64) for name in v.FIELDS)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(lengths) // WORDS_TOGETHER)) + 1).tolist(), len(rows)]
    return [rows.slice(start, end - start) for start, end in zip(cuts, cuts[1:]) if end > start]


def row_term_counts(words: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """``field_term_counts`` of each row on its own: nothing is shuffled, and a task holds the words of a few rows."""
    ship_package(words.sparkSession)
    rows = words.select("Id", *v.FIELDS)
    counts = [StructField(name, LongType(), False) for name in v.FIELDS]
    schema = StructType([rows.schema["Id"], StructField("Word", StringType()), *counts])
    left_out = list(stop_words)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dropped = pa.array(left_out, pa.string())
        for batch in batches:
            for run in runs_of_rows(batch):
                yield count_words(run, dropped)

    return rows.mapInArrow(task, schema)


def field_term_counts(words: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """All five counts in one pass, without ``stop_words``.

    Same rows as merging the five ``term_frequency`` tables. A document's words sit in one input row, so they are counted
    there; a table of all words and documents, which would fill the tasks' memory and be spilled and shuffled, is not
    grouped. Only documents of several rows, found by their ids beforehand, are added up by one shuffle.
    """
    ids = words.groupBy("Id").agg(F.count("*").alias("rows")).where("rows > 1")
    repeated = stored(ids.select(F.col("Id").alias("repeated_id")), "repeated_ids")
    if repeated.isEmpty():
        return row_term_counts(words, stop_words)
    same = F.col("Id").eqNullSafe(F.col("repeated_id"))
    several = row_term_counts(words.join(repeated, same, "left_semi"), stop_words)
    added = several.groupBy("Id", "Word").agg(*[F.sum(name).alias(name) for name in v.FIELDS])
    return row_term_counts(words.join(repeated, same, "left_anti"), stop_words).unionByName(added)


def stem_vocabulary(words: DataFrame, mode: str = "extended") -> DataFrame:
    """``(Word, Stem)`` for every distinct word of a table with a ``Word`` column."""
    vocabulary = words.select("Word").distinct()
    return vocabulary.withColumn("Stem", stemming.stem_text(F.col("Word"), mode))


def document_frequencies(counts: DataFrame) -> DataFrame:
    """``(Word, documents)``: in how many documents a word occurs."""
    return counts.groupBy("Word").agg(F.count("*").alias("documents"))
