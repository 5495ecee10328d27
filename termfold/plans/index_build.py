"""The index job: pages in, primary and secondary index out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termfold import values as v
from termfold.functions import scoring
from termfold.operators.counts import document_frequencies, field_term_counts
from termfold.operators.documents import field_documents, stemmed_documents, tokenize_documents
from termfold.operators.lookup import secondary_index
from termfold.operators.postings import SEGMENT_SIZE, inverted_index
from termfold.operators.ranking import vocabulary_rank, with_batch
from termfold.session import reused, scratch_run, stored

# Postings one task writes to a batch, some hundred megabytes before compression.
POSTINGS_PER_FILE = 10_000_000
# Bytes of a row group before compression, some hundred thousand postings: what a reader unpacks together.
ROW_GROUP_BYTES = 8 << 20

POSTING_TYPE = ", ".join(["doc_id: string", *[f"{name}: bigint" for name in scoring.COUNTS]])
PRIMARY_SCHEMA = f"Word string, segment int, Postings array<struct<{POSTING_TYPE}>>, batch int"
SECONDARY_SCHEMA = "batch int, first_word string"
MANIFEST_SCHEMA = "batch int, file string, first_word string, last_word string, rows long"


@dataclass(frozen=True)
class Index:
    """A written index. Tables are opened when they are asked for: only ``primary`` lists all batch folders."""

    spark: SparkSession
    path: str

    @property
    def secondary(self) -> DataFrame:
        return self.spark.read.schema(SECONDARY_SCHEMA).parquet(f"{self.path}/secondary")

    @property
    def manifest(self) -> DataFrame:
        """``(batch, file, first_word, last_word, rows)`` of every file of the primary index."""
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.path}/manifest")

    @property
    def primary(self) -> DataFrame:
        return self.spark.read.schema(PRIMARY_SCHEMA).parquet(f"{self.path}/primary")

    def files(self, names: list[str]) -> DataFrame:
        """The primary index in some of its files; no folder is listed."""
        base = f"{self.path}/primary"
        if not names:
            return self.spark.createDataFrame([], PRIMARY_SCHEMA)
        return self.spark.read.schema(PRIMARY_SCHEMA).option("basePath", base).parquet(*[f"{base}/{n}" for n in names])


def batched_vocabulary(counts: DataFrame, batch_size: int = v.BATCH_SIZE) -> DataFrame:
    """``(Word, documents, rank, batch)`` of every indexed word."""
    return with_batch(vocabulary_rank(document_frequencies(counts)), batch_size)


def index_statistics(counts: DataFrame, batch_size: int = v.BATCH_SIZE) -> DataFrame:
    """Vocabulary size, the batches it is planned for and those that hold words.

    A vocabulary that is a multiple of the batch size is planned with an empty
    last batch; such a batch is not written.
    """
    words = F.count_distinct("Word")
    return counts.agg(
        words.alias("words"),
        (F.floor(words / batch_size) + 1).alias("planned_batches"),
        F.ceil(words / batch_size).alias("written_batches"),
    )


def with_chunk(vocabulary: DataFrame, postings_per_file: int) -> DataFrame:
    """Cut each batch into chunks of consecutive words with about as many postings.

    The window runs over the words of one batch, so its groups are ``batch_size`` rows.
    """
    before = Window.partitionBy("batch").orderBy("Word").rowsBetween(Window.unboundedPreceding, -1)
    postings = F.sum(F.least(F.col("documents"), F.lit(postings_per_file))).over(before)
    chunk = F.floor(F.coalesce(postings, F.lit(0)) / postings_per_file)
    return vocabulary.withColumn("chunk", chunk)


def batched_postings(
    counts: DataFrame,
    vocabulary: DataFrame,
    segment_size: int = SEGMENT_SIZE,
    postings_per_file: int = POSTINGS_PER_FILE,
) -> DataFrame:
    """``(batch, chunk, part, Word, segment, Postings)``: posting lists and where they go.

    Batches are joined on word and segment, the key the postings are grouped by:
    the posting lists are not shuffled again for it, and a frequent word's
    segments stay apart. ``part`` numbers the files a very frequent word fills.
    """
    last_segment = (F.ceil(F.col("documents") / segment_size) - 1).cast("int")
    segments_per_file = max(1, postings_per_file // segment_size)
    places = with_chunk(vocabulary, postings_per_file).select(
        "Word", "batch", "chunk", F.explode(F.sequence(F.lit(0), last_segment)).alias("segment")
    )
    postings = inverted_index(counts, segment_size, vocabulary)
    return (
        postings.join(places, ["Word", "segment"])
        .withColumn("part", F.floor(F.col("segment") / segments_per_file))
        .select("batch", "chunk", "part", "Word", "segment", "Postings")
    )


def write_primary(postings: DataFrame, path: str) -> None:
    """One directory per batch, sorted by word so that file and row-group statistics prune.

    A batch is written by as many tasks as it has chunks and parts, so neither a
    large batch nor a frequent word ends up in one task. The whole table is
    replaced: batches of an earlier, larger run do not stay behind.

    Readers unpack up to 4096 rows of a row group at once, which are all the postings of a file if its lists are long.
    Sizes are looked at from the first row on, not after the usual 100: these may be 100 lists of ``segment_size``.
    """
    (
        postings.repartition("batch", "chunk", "part")
        .drop("chunk", "part")
        .sortWithinPartitions("batch", "Word", "segment")
        .write.partitionBy("batch")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size.row.check.min", 1)
        .mode("overwrite")
        .parquet(path)
    )


def write_secondary(secondary: DataFrame, path: str) -> None:
    secondary.sortWithinPartitions("batch").write.mode("overwrite").parquet(path)


def write_manifest(spark: SparkSession, path: str) -> None:
    """Note which files hold which batch and words: listed once here, not by every search.

    Reads the word column of the written index. File names are relative, so an index can be moved.
    """
    words = Index(spark, path).primary.select("batch", F.col("_metadata.file_path").alias("file"), "Word")
    files = words.groupBy("batch", "file").agg(
        F.min("Word").alias("first_word"), F.max("Word").alias("last_word"), F.count("*").alias("rows")
    )
    files = files.withColumn("file", F.substring_index("file", "/primary/", -1))
    files.repartitionByRange("batch").sortWithinPartitions("batch", "first_word").write.mode("overwrite").parquet(f"{path}/manifest")


def export_secondary_text(secondary: DataFrame, path: str) -> None:
    """One first word per line, line number = batch number: the order is the format, so it is one file.

    The first words are stored before they meet in the one task that writes them.
    """
    (
        stored(secondary, "first_words")
        .coalesce(1)
        .sortWithinPartitions("batch")
        .select("first_word")
        .write.mode("overwrite")
        .text(path)
    )


def write_index(
    counts: DataFrame,
    path: str,
    batch_size: int = v.BATCH_SIZE,
    segment_size: int = SEGMENT_SIZE,
    postings_per_file: int = POSTINGS_PER_FILE,
) -> None:
    """Write ``<path>/primary``, ``secondary`` and ``manifest`` from stored term-document counts."""
    with reused(batched_vocabulary(counts, batch_size)) as vocabulary:
        write_secondary(secondary_index(vocabulary), f"{path}/secondary")
        postings = batched_postings(counts, vocabulary, segment_size, postings_per_file)
        write_primary(postings, f"{path}/primary")
    write_manifest(counts.sparkSession, path)


def read_index(spark: SparkSession, path: str) -> Index:
    """A written index; the schemas are known, so no file is opened for them."""
    return Index(spark, path)


def page_counts(
    pages: DataFrame,
    stem: bool = True,
    stemmer: str = "extended",
    **fielding,
) -> DataFrame:
    """Term-document counts of pages; ``fielding`` goes to ``field_documents``."""
    documents = field_documents(pages, **fielding)
    if stem:
        return field_term_counts(stemmed_documents(documents, stemmer))
    return field_term_counts(tokenize_documents(documents), v.INDEX_STOP_WORDS)


def build_index(
    pages: DataFrame,
    path: str,
    batch_size: int = v.BATCH_SIZE,
    segment_size: int = SEGMENT_SIZE,
    **counting,
) -> None:
    """Index ``pages`` under ``path``; ``counting`` goes to ``page_counts``.

    The counts are stored once; frequencies, ranks and postings read them back,
    so pages are parsed, cleaned and stemmed a single time.
    """
    with scratch_run(pages.sparkSession):
        counts = stored(page_counts(pages, **counting), "term_documents")
        write_index(counts, path, batch_size, segment_size)
