"""Posting lists: built in bounded segments, as structs or as strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfold.functions import scoring
from termfold.operators.counts import document_frequencies
from termfold.session import stored

# Documents per posting-list segment. A word in more documents gets several rows.
SEGMENT_SIZE = 100_000
# Parts of a very frequent word's rows while its segments are looked up, and words that are looked up so.
SALTS = 64
SALTED_WORDS = 1000
# Postings that a task collects, some hundred megabytes.
POSTINGS_PER_TASK = 1_000_000


def document_slot(doc_id: Column) -> Column:
    """A number spread evenly over document ids."""
    return F.conv(F.substring(F.md5(doc_id), 1, 8), 16, 10).cast("long")


def frequent_words(frequencies: DataFrame, segment_size: int) -> DataFrame:
    """``(Word, segments)`` of the words that need more than one segment."""
    segments = F.ceil(F.col("documents") / segment_size)
    return frequencies.filter(F.col("documents") > segment_size).select(
        "Word", segments.alias("segments")
    )


def _more_than(words: DataFrame, number: int) -> bool:
    return words.limit(number + 1).count() > number


def _dealt(rows: DataFrame, tasks: int, *columns: str) -> DataFrame:
    """Rows dealt out by columns to at least ``tasks`` tasks."""
    if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return rows.repartition(tasks, *columns)
    return rows.repartition(*columns)


def _with_place(counts: DataFrame, frequent: DataFrame, tasks: int = 1) -> tuple[DataFrame, list[str]]:
    """Rows with their ``segment``, and the columns by which posting lists are grouped.

    The ``SALTED_WORDS`` most frequent words are joined once per salt, so that also a join that shuffles spreads their
    rows over ``SALTS`` tasks. A word that is none of them has at most one of ``SALTED_WORDS`` rows: if there are more
    frequent words, their segments are looked up where the rows of a word, or of a segment of a salted word, meet
    anyway to be grouped.
    """
    slot = document_slot(F.col("Id"))
    several = _more_than(frequent, SALTED_WORDS)
    most = frequent
    if several:
        most = stored(frequent.orderBy(F.desc("segments"), "Word").limit(SALTED_WORDS), "most_frequent_words")
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    salted = most.select("Word", "segments", salts.alias("salt"))
    segment = F.when(F.col("segments").isNotNull(), F.pmod(slot, F.col("segments"))).otherwise(0)
    placed = (
        counts.withColumn("salt", F.pmod(slot, F.lit(SALTS)))
        .join(salted, ["Word", "salt"], "left")
        .withColumn("segment", segment.cast("int"))
        .drop("segments", "salt")
    )
    if not several:
        return placed, ["Word", "segment"]
    # Written out, as a literal would leave the join's keys.
    others = stored(
        frequent.join(most, "Word", "left_anti").select("Word", F.lit(0).alias("part"), "segments"), "other_frequent_words"
    )
    segment = F.when(F.col("segments").isNotNull(), F.pmod(slot, F.col("segments"))).otherwise(F.col("part"))
    placed = (
        _dealt(placed.withColumnRenamed("segment", "part"), tasks, "Word", "part")
        .join(others, ["Word", "part"], "left")
        .withColumn("segment", segment.cast("int"))
        .drop("segments")
    )
    return placed, ["Word", "part", "segment"]


def with_segment(counts: DataFrame, frequent: DataFrame) -> DataFrame:
    """Number the segment of each term-document row; 0 for all but frequent words."""
    return _with_place(counts, frequent)[0].drop("part")


def inverted_index(
    counts: DataFrame,
    segment_size: int = SEGMENT_SIZE,
    frequencies: DataFrame | None = None,
) -> DataFrame:
    """``(Word, segment, Postings)`` from term-document counts, postings sorted by id.

    A word of a third of all documents fills many rows, each built by a task of
    its own and no longer than about ``segment_size``; any other word has one row.
    ``frequencies`` (``Word, documents``), where it is known already, saves
    reading ``counts`` a second time; pass stored counts otherwise.
    """
    if frequencies is None:
        frequencies = document_frequencies(counts)
    frequent = stored(frequent_words(frequencies, segment_size), "frequent_words")
    tasks = -(-counts.count() // POSTINGS_PER_TASK)
    placed, keys = _with_place(counts, frequent, tasks)
    if "part" not in keys:
        placed = _dealt(placed, tasks, *keys)
    lists = F.sort_array(F.collect_list(scoring.posting())).alias("Postings")
    return placed.groupBy(*keys).agg(lists).drop("part")


def encode_postings(index: DataFrame) -> DataFrame:
    """Postings as strings joined by ``#``, in ``Document_Counts``."""
    text = scoring.posting_list_string(F.col("Postings"))
    return index.withColumn("Document_Counts", text).drop("Postings")


def decode_postings(encoded: DataFrame) -> DataFrame:
    postings = scoring.parse_posting_list(F.col("Document_Counts"))
    return encoded.withColumn("Postings", postings).drop("Document_Counts")
