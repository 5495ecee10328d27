"""Pages from tables and lines from text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The documents table dressed as wiki pages: its texts carry no markup of their
# own, so infoboxes, citations, links and categories are put around them.
# Plain SQL expressions, so that other engines can evaluate them as well.
MARKUP_TITLE = "concat(lang, ' & ', source)"
MARKUP_TEXT = """concat(
  CASE WHEN doc_id % 5 = 0 THEN ''
       ELSE concat('Lead {{Infobox doc | name = {{lang|', lang, '}} | source = ', source, ' }} ') END,
  text,
  concat(' {{Cite web|url=', source, '}} <ref name="r1"> [[File:', source, '.png]]', chr(10)),
  CASE WHEN doc_id % 7 = 0 THEN ''
       ELSE concat('==External links==', chr(10), '* [http://', source, '.example.org ', lang, ' site]', chr(10)) END,
  concat('[[Category:', lang, ' texts]]', chr(10), '[[Category:', source, '-docs|', lang, ']]'))"""


# A harder view: no box, one of depth 4, two boxes with text between, an unclosed box after a closed one, odd braces.
NESTED_TEXT = """concat('Lead ', lang, ' ',
  CASE doc_id % 5
    WHEN 0 THEN ''
    WHEN 1 THEN concat('{{Infobox a ', source, ' {{b|{{c|{{d ', lang, '}} }} }} e}} ')
    WHEN 2 THEN concat('{{Infobox first ', source, '}} between {{cite}} {{Infobox second {{x}} ', lang, '}} ')
    WHEN 3 THEN concat('{{Infobox whole ', lang, '}} then {{Infobox open {{y}} ')
    ELSE concat('{{{Infobox odd {{{', source, '}}} {z} }} } ') END,
  text)"""


def nested_pages(documents: DataFrame) -> DataFrame:
    """``(Id, Text)`` pages with boxes of all kinds made from ``(doc_id, text, lang, source)``."""
    return documents.selectExpr("cast(doc_id AS string) AS Id", f"{NESTED_TEXT} AS Text")


def markup_pages(documents: DataFrame) -> DataFrame:
    """``(Id, Title, Text)`` wiki pages made from ``(doc_id, text, lang, source)``."""
    return documents.selectExpr(
        "cast(doc_id AS string) AS Id", f"{MARKUP_TITLE} AS Title", f"{MARKUP_TEXT} AS Text"
    )


def spread(df: DataFrame) -> DataFrame:
    """Use every core when a source arrives in fewer partitions than there are cores.

    Large sources have more splits than cores and pass through unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)
