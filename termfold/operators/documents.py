"""Pages to fielded documents, fielded documents to token arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfold import values as v
from termfold.functions import clean, fields, stemming, tokens


def sample_pages(pages: DataFrame, size: int) -> DataFrame:
    """The ``size`` pages with the lowest ids; the order makes the choice repeatable."""
    return pages.orderBy(F.col("Id").try_cast("long"), "Id").limit(size)


def clean_pages(pages: DataFrame, cleaning: str = "sequential", clean_title: bool = False) -> DataFrame:
    """Lower-cased pages with citations, files, tags and punctuation out of the body."""
    body = clean.CLEANERS[cleaning]
    title = clean.normalize_case(F.col("Title"))
    return pages.select(
        F.col("Id").cast("string").alias("Id"),
        (body(title) if clean_title else title).alias("Title"),
        body(clean.normalize_case(F.col("Text"))).alias("Text"),
    )


def split_infobox(cleaned: DataFrame) -> DataFrame:
    """Move the balanced infoboxes of Text to a column of their own.

    The remaining text gets a new name first: a lambda that names Text would
    otherwise read the replaced column of the same select.
    """
    text, positions = F.col("Text"), F.col("positions")
    return (
        cleaned.withColumn("positions", fields.infobox_positions(text))
        .withColumns(
            {
                "Infobox": fields.infobox_content(text, positions),
                "Remaining_Text": fields.text_after_infobox(text, positions),
            }
        )
        .drop("positions", "Text")
        .withColumnRenamed("Remaining_Text", "Text")
    )


def field_documents(
    pages: DataFrame,
    cleaning: str = "sequential",
    keep_body_without_links: bool = False,
    clean_title: bool = False,
) -> DataFrame:
    """Pages ``(Id, Title, Text)`` to documents with the five fields as clean strings."""
    cleaned = clean_pages(pages, cleaning, clean_title)
    with_categories = cleaned.withColumn("Categories", fields.extract_categories(F.col("Text")))
    parted = split_infobox(with_categories).withColumns(
        {
            "External_Links": fields.extract_external_links(F.col("Text")),
            "Text": fields.extract_body(F.col("Text"), keep_body_without_links),
        }
    )
    return parted.select(
        "Id",
        clean.squeeze_junk(F.col("Title")).alias("Title"),
        clean.squeeze_junk(F.col("Text")).alias("Text"),
        F.concat_ws(" ", clean.clean_categories(F.col("Categories"))).alias("Categories"),
        clean.squeeze_infobox(F.col("Infobox")).alias("Infobox"),
        clean.squeeze_junk(F.col("External_Links")).alias("External_Links"),
    )


def tokenize_documents(documents: DataFrame) -> DataFrame:
    """The five fields as arrays of non-empty words."""
    return documents.withColumns({field: tokens.tokenize(F.col(field)) for field in v.FIELDS})


def drop_stop_words(tokenized: DataFrame) -> DataFrame:
    return tokenized.withColumns(
        {field: tokens.without_index_stop_words(F.col(field)) for field in v.FIELDS}
    )


def stem_documents(tokenized: DataFrame, mode: str = "extended") -> DataFrame:
    return tokenized.withColumns(
        {field: stemming.stem_words(F.col(field), mode) for field in v.FIELDS}
    )


def stemmed_documents(documents: DataFrame, mode: str = "extended") -> DataFrame:
    """Tokens without stop words, stemmed: the three steps above on the field strings.

    The UDF needs each distinct word only once, for the stop list as for the stem.
    """
    return tokenize_documents(
        documents.withColumns(
            {
                field: stemming.stem_text(F.col(field), mode, dropped=v.INDEX_STOP_WORDS)
                for field in v.FIELDS
            }
        )
    )
