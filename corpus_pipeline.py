"""A corpus from raw documents in five stages, each of which calls one operator of ``termfold.llm``.

Every stage takes and returns the columns of ``documents`` (the last adds the tokens); what a stage decides takes effect
in the rows it returns:

- ``language``: documents without a letter, or far from every learned language, go.
- ``line_dedup``: lines that repeat earlier ones go, and documents left without a line. Of a document of whose words
  ``COPY_SHARE`` or more repeats lines of one earlier document, those lines stay: it is a copy as a whole, and the next
  stage judges copies as wholes. (Without that the copies would come to the next stage as empty texts and fragments.)
- ``near_duplicates``: of each group of linked documents the one with the smallest id stays. Of rows that share an id,
  all stay or go.
- ``mixing``: documents are sampled towards evened-out shares of sources, languages and topics.
- ``encoding``: texts are encoded into pieces with seeded merge-dropout.

``n_chars`` follows the text. Null ids: such documents are linked with nothing, so they pass ``near_duplicates``. Repeated
rows are copies of each other for ``line_dedup`` and one id for ``near_duplicates``: they stay or go together. An empty
table gives an empty table. Further columns come through unchanged, also under names that an operator uses for its own;
only ``encoding`` replaces columns named ``tokens``, ``n_tokens`` and ``lossless``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termfold.llm import jaccard, langid, lines, mixing, pieces
from termfold.session import ship_package, stored

#: Documents whose nearest profile is farther than this are in no learned language.
LEAST_SCORE = 0.2


#: Share of a document's words, repeated from one earlier document, from which on it is a copy as a whole.
COPY_SHARE = 0.5
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def _aside(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns but those of documents in one, where no operator replaces them."""
    others = [c for c in docs.columns if c not in DOCUMENT]
    return docs.select(*DOCUMENT, F.struct(*others).alias("_others")) if others else docs


def _back(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``."""
    return found.select([F.col(c if c in DOCUMENT else f"_others.`{c}`").alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    profiles = langid.learn_profiles(docs.where(~langid.held_out(F.col("doc_id"))))
    known = langid.identify(_aside(docs), profiles)
    known = known.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return _back(known, docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    kept = lines.dedup_lines(_aside(docs), copy_share=COPY_SHARE).where(F.col("text").rlike(r"\S"))
    return _back(kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    found = jaccard.near_duplicates(docs.select("doc_id", "text"))
    # Only documents that go are looked for: the others need not be moved.
    gone = stored(found.where("component_id <> doc_id").select("doc_id").distinct(), "near_duplicates")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return _back(mixing.mix(_aside(docs)).where("kept"), docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pieces.encode(docs, pieces.read_model())


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mix),
    ("encoding", encoding),
]

#: Ranked profiles, raking and merges are not expressible in SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written before the next one reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
