
from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import duckdb_oracle
from termfold import values as v
from termfold.functions import clean, fields, scoring, tokens
from termfold.operators import documents as docs
from termfold.operators import keyed, lookup, postings, ranking, wordcount
from termfold.operators import counts as count_ops
from termfold.plans import index_build, search
from termfold.session import scratch_path, ship_package, stored
from termfold.sources import tables, xml

try:
    import corpus_pipeline
    from termfold.llm import registry as llm
except ImportError:  # the folder is not there, or a package it needs
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

# Tables and indexes several queries start from, written once per application.
_written: dict[tuple, object] = {}


def _once(spark: SparkSession, key: tuple, make: Callable[[], object]) -> object:
    key = (spark.sparkContext.applicationId, *key)
    if key not in _written:
        _written[key] = make()
    return _written[key]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return tables.markup_pages(tables.spread(_table(spark, sf_dir, "documents")))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.clean_pages(_pages(spark, sf_dir))


def _boxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.split_infobox(_cleaned(spark, sf_dir))


def _parted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields split but not yet cleaned, step by step."""
    cleaned = _cleaned(spark, sf_dir)
    boxed = docs.split_infobox(
        cleaned.withColumn("Categories", fields.extract_categories(F.col("Text")))
    )
    return boxed.withColumns(
        {
            "External_Links": fields.extract_external_links(F.col("Text")),
            "Text": fields.extract_body(F.col("Text")),
        }
    )


def _fielded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.field_documents(_pages(spark, sf_dir))


def _stopped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.drop_stop_words(docs.tokenize_documents(_fielded(spark, sf_dir)))


def _counts(spark: SparkSession, sf_dir: str, stem: bool = False) -> DataFrame:
    def make() -> DataFrame:
        counts = index_build.page_counts(_pages(spark, sf_dir), stem=stem)
        return stored(counts, "term_documents")

    return _once(spark, ("counts", sf_dir, stem), make)


def _vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _counts(spark, sf_dir)
    return _once(spark, ("vocabulary", sf_dir), lambda: index_build.batched_vocabulary(counts))


def _index(spark: SparkSession, sf_dir: str, stem: bool = False) -> index_build.Index:
    counts = _counts(spark, sf_dir, stem)

    def make() -> str:
        path = scratch_path(spark, "index")
        index_build.write_index(counts, path)
        return path

    return index_build.read_index(spark, _once(spark, ("index", sf_dir, stem), make))


def _queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return _table(spark, sf_dir, "benchmark").selectExpr("item_id AS query_id", "text AS query")


def _dump(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "dump")
    xml.write_page_elements(_pages(spark, sf_dir), path)
    return path


# --- scans, sinks and projections --------------------------------------------


def xml_page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xml.read_pages(spark, _dump(spark, sf_dir), whole_files=True)


def xml_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xml.read_pages(spark, _dump(spark, sf_dir))


def page_initial_capitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    elements = xml.read_page_elements(spark, _dump(spark, sf_dir))
    return xml.page_documents(elements, initial_capitals=True)


def page_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.sample_pages(_pages(spark, sf_dir), 20)


def word_count_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "counts")
    wordcount.write_counts(word_count_docs(spark, sf_dir), path)
    return tables.read_lines(spark, path)


def word_count_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    tables.spread(_table(spark, sf_dir, "documents")).select("text").write.text(path)
    return wordcount.word_count(tables.read_lines(spark, path))


# --- cleaning and fields ------------------------------------------------------


def normalize_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select(
        "Id",
        clean.normalize_case(F.col("Title")).alias("Title"),
        clean.normalize_case(F.col("Text")).alias("Text"),
    )


def clean_body_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.clean_pages(_pages(spark, sf_dir), "sequential").select("Id", "Text")


def clean_body_single_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.clean_pages(_pages(spark, sf_dir), "single_pass").select("Id", "Text")


def clean_html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = clean.normalize_case(F.col("html"))
    pages = tables.spread(_table(spark, sf_dir, "pages"))
    return pages.select("page_id", clean.clean_body_sequential(html).alias("Text"))


def extract_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array_join(fields.extract_categories(F.col("Text")), "\n")
    return _cleaned(spark, sf_dir).select("Id", names.alias("Categories"))


def extract_infobox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boxed(spark, sf_dir).select("Id", "Infobox", F.col("Text").alias("Remaining_Text"))


def extract_infobox_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.nested_pages(tables.spread(_table(spark, sf_dir, "documents")))
    boxed = docs.split_infobox(pages.withColumn("Text", clean.normalize_case(F.col("Text"))))
    return boxed.select("Id", "Infobox", F.col("Text").alias("Remaining_Text"))


def extract_external_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parted(spark, sf_dir).select("Id", "External_Links")


def extract_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parted(spark, sf_dir).select("Id", "Text")


def extract_body_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = fields.extract_body(F.col("Text"), keep_body_without_links=True)
    return _boxed(spark, sf_dir).select("Id", body.alias("Text"))


def strip_junk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parted(spark, sf_dir).select(
        "Id",
        clean.strip_title_junk(F.col("Title")).alias("Title"),
        clean.strip_junk(F.col("Text")).alias("Text"),
        clean.strip_junk(F.col("External_Links")).alias("External_Links"),
    )


def clean_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.concat_ws(" ", clean.clean_categories(F.col("Categories")))
    return _parted(spark, sf_dir).select("Id", names.alias("Categories"))


def clean_infobox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parted(spark, sf_dir).select("Id", clean.clean_infobox(F.col("Infobox")).alias("Infobox"))


def squeeze_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    squeeze = clean.squeeze_whitespace
    return _parted(spark, sf_dir).select(
        "Id",
        squeeze(clean.strip_title_junk(F.col("Title"))).alias("Title"),
        squeeze(clean.strip_junk(F.col("Text"))).alias("Text"),
        squeeze(clean.clean_infobox(F.col("Infobox"))).alias("Infobox"),
        squeeze(clean.strip_junk(F.col("External_Links"))).alias("External_Links"),
    )


def field_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fielded(spark, sf_dir)


def field_documents_single_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.field_documents(_pages(spark, sf_dir), cleaning="single_pass")


# --- tokens and counts --------------------------------------------------------


def _joined(words: DataFrame) -> DataFrame:
    return words.select("Id", *[F.array_join(field, "|").alias(field) for field in v.FIELDS])


def tokenize_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(docs.tokenize_documents(_fielded(spark, sf_dir)))


def stop_words_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(_stopped(spark, sf_dir))


def _term_frequency(field: str) -> Query:
    return lambda spark, sf_dir: count_ops.term_frequency(_stopped(spark, sf_dir), field)


def term_doc_outer_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = stored(_stopped(spark, sf_dir), "words")
    return count_ops.merge_term_frequencies(
        [count_ops.term_frequency(words, field) for field in v.FIELDS]
    )


def field_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_build.page_counts(_pages(spark, sf_dir), stem=False)


def stem_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_ops.stem_vocabulary(_counts(spark, sf_dir))


def stemmed_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_build.page_counts(_pages(spark, sf_dir), stem=True)


# --- index --------------------------------------------------------------------


def _listed(index: DataFrame) -> DataFrame:
    return index.select(
        "Word",
        "segment",
        F.size("Postings").cast("long").alias("documents"),
        F.array_join(F.col("Postings.doc_id"), ",").alias("doc_ids"),
    )


def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(postings.inverted_index(_counts(spark, sf_dir)))


def inverted_index_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(postings.inverted_index(_counts(spark, sf_dir), segment_size=40))


def posting_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.encode_postings(postings.inverted_index(_counts(spark, sf_dir)))


def decode_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = postings.decode_postings(posting_strings(spark, sf_dir))
    # No list is empty. A plain explode would test that first, which makes and parses every string once more.
    return decoded.select("Word", F.explode_outer("Postings").alias("posting")).select("Word", "posting.*")


def posting_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = postings.inverted_index(_counts(spark, sf_dir))
    posting = F.col("posting")
    return index.select("Word", F.explode("Postings").alias("posting")).select(
        "Word", "posting.doc_id", scoring.posting_score(posting).alias("score")
    )


def index_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_build.index_statistics(_counts(spark, sf_dir))


def vocabulary_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocabulary(spark, sf_dir).select("Word", "rank")


def index_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocabulary(spark, sf_dir).select("Word", F.col("batch").alias("Batch_Number"))


def secondary_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.secondary_index(_vocabulary(spark, sf_dir))


def secondary_index_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "secondary_text")
    index_build.export_secondary_text(secondary_index(spark, sf_dir), path)
    return tables.read_lines(spark, path)


def union_first_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    of_batches = secondary_index(spark, sf_dir).select("first_word")
    of_queries = query_terms(spark, sf_dir).groupBy("query_id").agg(F.min("Word").alias("first_word"))
    return lookup.append_first_words(of_batches, of_queries.select("first_word"))


def _index_rows(index: DataFrame) -> DataFrame:
    return postings.encode_postings(index).select("batch", "Word", "segment", "Document_Counts")


def index_write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index_rows(_index(spark, sf_dir).primary)


def stemmed_index_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index_rows(_index(spark, sf_dir, stem=True).primary)


# --- search -------------------------------------------------------------------


def query_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.query_terms(_queries(spark, sf_dir), stem=False)


def query_terms_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.query_terms(_queries(spark, sf_dir), stem=True)


def secondary_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = F.regexp_extract_all(F.lower("text"), F.lit(v.QUERY_WORD), F.lit(0))
    conversations = _table(spark, sf_dir, "conversations")
    words = conversations.select(F.explode(runs).alias("Word")).distinct()
    return lookup.secondary_lookup(words, secondary_index(spark, sf_dir))


def index_term_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = stored(query_terms(spark, sf_dir), "query_terms")
    found = search.term_lookup(terms, _index(spark, sf_dir), lists=postings.encode_postings)
    return found.select("query_id", "Word", "repeats", "segment", "Document_Counts")


def search_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_queries(spark, sf_dir), _index(spark, sf_dir), stem=False)


def search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank_results(search_scores(spark, sf_dir))


def search_result_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.result_documents(_queries(spark, sf_dir), search_ranked(spark, sf_dir))


def search_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.listing(_queries(spark, sf_dir), search_ranked(spark, sf_dir))


def search_result_json_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = search_ranked(spark, sf_dir)
    return search.result_documents(_queries(spark, sf_dir), ranked, results_per_document=100)


def stemmed_search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir, stem=True)
    return search.rank_results(search.search(_queries(spark, sf_dir), index, stem=True))


# --- keyed documents ----------------------------------------------------------


def keyed_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "documents")
    keyed.keyed_sink(_fielded(spark, sf_dir), path)
    return spark.read.parquet(path)


def upsert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels")
    conversations = _table(spark, sf_dir, "conversations")
    id_of_label = F.col("doc_id").cast("string").alias("Id")
    puts = (
        labels.select(
            id_of_label,
            F.lit(1).cast("long").alias("sequence"),
            F.concat(F.lit("quality "), F.col("quality")).alias("Categories"),
        )
        .unionByName(
            labels.select(
                id_of_label,
                F.lit(2).cast("long").alias("sequence"),
                F.concat(F.lit("toxic "), F.col("toxic")).alias("Infobox"),
            ),
            allowMissingColumns=True,
        )
        .unionByName(
            conversations.select(
                F.concat(F.lit("conversation-"), F.col("conv_id")).alias("Id"),
                F.col("turn").alias("sequence"),
                F.col("role").alias("Title"),
                F.col("text").alias("Text"),
            ),
            allowMissingColumns=True,
        )
        .withColumn("External_Links", F.lit(None).cast("string"))
    )
    path = scratch_path(spark, "documents")
    keyed.write_keyed_table(_fielded(spark, sf_dir), path)
    keyed.put_documents(spark, path, puts)
    return keyed.read_keyed_table(spark, path)


def keyed_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _fielded(spark, sf_dir)
    path = scratch_path(spark, "created")
    name = "created_" + path.split("/")[-2]
    for _ in range(2):  # the second time it is there already
        keyed.create_if_missing(spark, name, documents.schema, path)
    documents.write.insertInto(name)
    created = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    return spark.read.schema(created).parquet(path)


def keyed_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = keyed.encoded(_fielded(spark, sf_dir))
    return encoded.select([F.hex(c).alias(c) for c in encoded.columns])


# --- contract -----------------------------------------------------------------

_REGISTERED: list[Query] = [
    xml_page_scan, xml_split_scan, page_initial_capitals, page_sample, word_count_docs, word_count_output,
    normalize_case, clean_body_sequential, clean_body_single_pass, clean_html_pages,
    extract_categories, extract_infobox, extract_infobox_nested, extract_external_links, extract_body, extract_body_kept,
    strip_junk, clean_categories, clean_infobox, squeeze_whitespace,
    field_documents, field_documents_single_pass,
    tokenize_fields, stop_words_index, term_doc_outer_merge, field_term_counts,
    stem_vocabulary, stemmed_term_counts,
    inverted_index, inverted_index_segments, posting_strings, decode_postings, posting_scores,
    index_stats, vocabulary_rank, index_batches, secondary_index, secondary_index_text,
    union_first_words, index_write_roundtrip, stemmed_index_roundtrip,
    query_terms, query_terms_stemmed, secondary_lookup, index_term_lookup,
    search_scores, search_ranked, search_listing, search_result_json, search_result_json_parts,
    stemmed_search_ranked, keyed_sink, keyed_create, upsert_documents, keyed_encode,
]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: index the pages and rank every benchmark text against them."""
    return search_ranked(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    named = {query.__name__: query for query in _REGISTERED}
    named.update({f"tf_{field.lower()}": _term_frequency(field) for field in v.FIELDS})
    if llm:
        named.update(llm.queries())
        named["pipeline"] = corpus_pipeline.run
    return named


def oracle_sql() -> dict[str, str]:
    statements = duckdb_oracle.statements()
    if llm:
        statements.update(llm.ORACLE_SQL)
        if corpus_pipeline.ORACLE_SQL:
            statements["pipeline"] = corpus_pipeline.ORACLE_SQL
    return statements
