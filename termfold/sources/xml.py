"""XML dumps: one row per ``<page>`` element."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termfold.session import stored

# Given, not inferred: inference is a second pass over the dump.
PAGE_SCHEMA = (
    "id long, title string, revision struct<text: struct<_VALUE: string, _bytes: long>>"
)
ATTRIBUTE = r"""\s+[^\s=<>/"']+\s*=\s*(?:"[^"]*"|'[^']*')"""
PAGE_START = rf"<page(?:{ATTRIBUTE})*\s*>"
# Records are cut in front of the mark that closes an end tag, so that a record shows whether the one before it is whole.
PAGE_END = "</page"
REST_OF_END = r"^\s*>"
HIDDEN = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
OPENING = r"<!--|<!\[CDATA\["
OUTSIDE, COMMENT, CDATA = 0, 1, 2
FILE = "_metadata.file_path"
# Up to this many files that are not plain are told from the others by name; more, and all are read by state.
NAMED_FILES = 1000


def read_page_elements(spark: SparkSession, path: str, whole_files: bool = False, checked: bool = True) -> DataFrame:
    """``id, title, revision`` of every page of a dump.

    The text scan is split by Spark at any byte, so files of all sizes are read alike. Records end at ``</page``; what
    precedes a page's start, the header of the dump, is cut off, and what follows the last page holds no start.

    A first scan counts records, starts and marks by file. In a plain file every record but the last is a page. A file that
    ends inside a page fails. Files with comments, CDATA, pages without an end tag or other tags that begin alike are cut
    into records by state (``_stateful_pages``); a page inside a comment is none, and a literal ``</page>`` in CDATA ends
    nothing. ``checked=False`` leaves this scan out, for dumps known to be plain and whole.

    ``whole_files`` takes each file through the XML reader instead, in one task. Both give the same rows: an empty page
    (``<page/>``, or none of the three elements) is no row, and a page that does not parse, or a file that ends inside
    one, fails the job. One known difference: the parser behind ``whole_files`` loses an element's text before a comment.
    """
    if whole_files:
        options = {"rowTag": "page", "mode": "FAILFAST"}
        pages = spark.read.format("xml").options(**options).schema(PAGE_SCHEMA).load(path)
    else:
        records = spark.read.option("lineSep", PAGE_END).text(path)
        odd = _odd_files(records) if checked else []
        of_odd = F.col(FILE).isin(odd) if len(odd) <= NAMED_FILES else F.lit(True)
        pages = _parsed(records.where(~of_odd & F.col("value").rlike(PAGE_START)).select("value"))
        if odd:
            pages = pages.unionByName(_parsed(_stateful_pages(records.where(of_odd))))
    return pages.filter("id is not null or title is not null or revision is not null")


def _parsed(pages: DataFrame) -> DataFrame:
    """Pages of records that hold one from its start to before its end tag."""
    page = F.concat(F.regexp_extract("value", f"(?s){PAGE_START}.*", 0), F.lit(f"{PAGE_END}>"))
    element = F.from_xml(page, PAGE_SCHEMA, {"rowTag": "page", "mode": "FAILFAST"})
    return pages.select(element.alias("page")).select("page.*")


def _odd_files(records: DataFrame) -> list[str]:
    """Files whose records are not all pages but the last: one row for each file is aggregated, only odd ones come here."""
    value = F.col("value")
    counted = records.groupBy(F.col(FILE).alias("file")).agg(
        F.count("*").alias("records"),
        F.count_if(value.rlike(PAGE_START)).alias("starts"),
        F.count_if(value.rlike(REST_OF_END)).alias("ends"),
        F.count_if(value.rlike(OPENING)).alias("marks"),
    )
    plain = (F.col("marks") == 0) & (F.col("ends") == F.col("records") - 1)
    cut_off = plain & (F.col("starts") == F.col("records"))
    odd = counted.where(~plain | (F.col("starts") != F.col("records") - 1))
    rows = odd.select("file", cut_off.alias("cut_off")).collect()
    if broken := [r.file for r in rows if r.cut_off]:
        raise ValueError(f"the file ends inside a page: {', '.join(sorted(broken)[:5])}")
    return [r.file for r in rows]


def _state_after(value: Column, state: int) -> Column:
    """The state at the end of a record that begins in ``state``."""
    if state == OUTSIDE:
        opened = F.regexp_extract(F.regexp_replace(value, HIDDEN, " "), OPENING, 0)
        return F.when(opened == "<!--", COMMENT).when(opened == "", OUTSIDE).otherwise(CDATA)
    closing = "-->" if state == COMMENT else "]]>"
    rest = F.substring(value, F.instr(value, closing) + len(closing), F.length(value))
    return F.when(F.instr(value, closing) == 0, state).otherwise(_state_after(rest, OUTSIDE))


def _numbered(records: DataFrame) -> DataFrame:
    """``file, block, row, start, page, last`` of each record: the state it begins in and the page it belongs to.

    What a record does to each state is found where it lies; only these few numbers are put in order, file by file, and
    composed in a streamed pass.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, state, page = None, OUTSIDE, 0
        for batch in batches:
            starts, pages = [], []
            columns = [batch.column(i).to_pylist() for i in (0, 3, 4, 5, 6)]
            for name, closes, *after in zip(*columns):
                if name != file:
                    file, state, page = name, OUTSIDE, 0
                elif closes and state == OUTSIDE:
                    page += 1
                starts.append(state)
                pages.append(page)
                state = after[state]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(starts, pa.int32()), pa.array(pages, pa.int64())], names=names)

    names = ["file", "block", "row", "start", "page"]
    after = [_state_after(F.col("value"), state).cast("int").alias(f"after{state}") for state in (OUTSIDE, COMMENT, CDATA)]
    effects = records.select("file", "block", "row", F.col("value").rlike(REST_OF_END).alias("closes"), *after)
    ordered = effects.repartition("file").sortWithinPartitions("file", "block", "row")
    return ordered.mapInArrow(task, "file string, block long, row long, start int, page long")


def _stateful_pages(records: DataFrame) -> DataFrame:
    """``value`` from a page's start to before its end tag, with comments dropped and CDATA as escaped text."""
    placed = records.select(
        "value",
        F.col(FILE).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = stored(placed, "xml_records")
    numbered = stored(_numbered(placed), "xml_record_states")
    pieces = placed.join(numbered, ["file", "block", "row"]).groupBy("file", "page")
    pieces = pieces.agg(F.sort_array(F.collect_list(F.struct("block", "row", "value"))).alias("parts"))
    lasts = numbered.groupBy("file").agg(F.max("page").alias("last"))
    whole = F.regexp_replace(F.array_join(F.col("parts.value"), PAGE_END), REST_OF_END, "")
    shown = F.regexp_replace(whole, r"(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?-->", "$1")
    pages = pieces.join(lasts, "file").select("file", (F.col("page") == F.col("last")).alias("last"), _escaped(shown).alias("value"))
    # What is left open at the end of a file hides the ends of what precedes it, so it is in the last record as well.
    starts = F.col("value").rlike(PAGE_START)
    unclosed = F.col("last") & (starts | F.col("value").rlike(OPENING))
    failed = F.raise_error(F.concat(F.lit("the file ends inside a page: "), "file"))
    return pages.where(starts | unclosed).select(F.when(unclosed, failed).otherwise(F.col("value")).alias("value"))


def _escaped(value: Column) -> Column:
    """CDATA sections as text with references."""
    pieces = F.split(value, r"<!\[CDATA\[")

    def plain(piece: Column) -> Column:
        literal = F.replace(F.replace(F.replace(F.substring_index(piece, "]]>", 1), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        end = F.instr(piece, "]]>")
        # Without an end it stays as it is, to be refused.
        return F.when(end == 0, F.concat(F.lit("<![CDATA["), piece)).otherwise(F.concat(literal, F.substring(piece, end + 3, F.length(piece))))

    others = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), plain)
    return F.concat(F.element_at(pieces, 1), F.array_join(others, ""))


def page_documents(elements: DataFrame, initial_capitals: bool = False) -> DataFrame:
    """``(Id, Title, Text)`` as strings; a missing body is ''.

    ``initial_capitals`` capitalises each word, for display: cleaning lower-cases
    everything anyway.
    """
    columns = {
        "Id": F.col("id").cast("string"),
        "Title": F.col("title"),
        "Text": F.coalesce(F.col("revision.text._VALUE"), F.lit("")),
    }
    if initial_capitals:
        columns = {name: F.initcap(column) for name, column in columns.items()}
    return elements.select([column.alias(name) for name, column in columns.items()])


def read_pages(spark: SparkSession, path: str, whole_files: bool = False, checked: bool = True) -> DataFrame:
    """Pages of a dump as ``(Id, Title, Text)``; see ``read_page_elements``."""
    return page_documents(read_page_elements(spark, path, whole_files, checked))


def write_page_elements(pages: DataFrame, path: str) -> None:
    """Write ``(Id, Title, Text)`` as a dump of ``<page>`` elements."""
    text = F.struct(F.col("Text").alias("_VALUE"), F.octet_length("Text").cast("long").alias("_bytes"))
    (
        pages.select(
            F.col("Id").cast("long").alias("id"),
            F.col("Title").alias("title"),
            F.struct(text.alias("text")).alias("revision"),
        )
        .write.format("xml")
        .option("rootTag", "mediawiki")
        .option("rowTag", "page")
        .save(path)
    )
