"""The secondary index: the first word of every batch, and looking words up in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termfold.operators.ranking import range_sorted
from termfold.session import stored

# Words per aggregate in locate_words.
WORDS_PER_PASS = 100


def secondary_index(batched_words: DataFrame) -> DataFrame:
    """``(batch, first_word)`` from ``(Word, batch)``."""
    return batched_words.groupBy("batch").agg(F.min("Word").alias("first_word"))


def append_first_words(known: DataFrame, more: DataFrame) -> DataFrame:
    """Bag union of two sets of first words."""
    return known.unionByName(more)


def secondary_lookup(words: DataFrame, secondary: DataFrame) -> DataFrame:
    """``(Word, batch)`` per distinct word: the last batch whose first word is not after it.

    A word before every batch gets no row. Words and first words are merged into
    one sorted sequence and each word takes the batch last seen. Batches grow
    with their first words, so "last seen" is a running maximum: one inside each
    slice, and one over the slices' maxima for what came before the slice. No
    pairs of words and batches are formed, whatever the two sizes.
    """
    marks = secondary.select(F.col("first_word").alias("Word"), F.lit(0).alias("kind"), "batch")
    probes = words.select("Word").distinct().withColumns(
        {"kind": F.lit(1), "batch": F.lit(None).cast("int")}
    )
    merged = range_sorted(marks.unionByName(probes), "Word", "kind")

    earlier_slices = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice, however large the inputs are.
    reached = stored(
        merged.groupBy("slice")
        .agg(F.max("batch").alias("slice_batch"))
        .select("slice", F.max("slice_batch").over(earlier_slices).alias("reached")),
        "reached",
    )
    in_slice = Window.partitionBy("slice").orderBy("place")
    return (
        merged.withColumn("seen", F.max("batch").over(in_slice))
        .filter(F.col("kind") == 1)
        .join(reached, "slice")
        .select("Word", F.greatest("seen", "reached").alias("batch"))
        .filter(F.col("batch").isNotNull())
    )


def locate_words(secondary: DataFrame, words: list[str]) -> dict[str, int]:
    """The same lookup for a few words in hand: one scan, one aggregate per word."""
    located = {}
    for start in range(0, len(words), WORDS_PER_PASS):
        some = words[start : start + WORDS_PER_PASS]
        batches = [
            F.max(F.when(F.col("first_word") <= F.lit(word), F.col("batch"))).alias(f"batch_{i}")
            for i, word in enumerate(some)
        ]
        found = secondary.agg(*batches).first()
        located.update({word: b for word, b in zip(some, found) if b is not None})
    return located
