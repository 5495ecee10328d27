"""Headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every job runs twice and the shorter time counts: the first run also compiles.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfold.operators import keyed
from termfold.operators.documents import field_documents, stemmed_documents, tokenize_documents
from termfold.operators.wordcount import word_count
from termfold.plans import index_build, search
from termfold.session import local_session, scratch_path
from termfold.sources import tables, xml

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, memory="16g", **{"spark.sql.shuffle.partitions": CPUS})
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    pages = tables.markup_pages(tables.spread(documents))
    queries = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").selectExpr("item_id AS query_id", "text AS query")
    one_query = search.single_query(spark, "the source of ten texts")
    dump = scratch_path(spark, "dump")
    plain, stemmed = scratch_path(spark, "plain"), scratch_path(spark, "stemmed")
    xml.write_page_elements(pages, dump)
    table = scratch_path(spark, "keyed")
    puts = documents.where("doc_id % 100 = 0").selectExpr("cast(doc_id AS string) AS Id", "1L AS sequence", "upper(source) AS Title")

    def find(asked: DataFrame, path: str, stem: bool) -> None:
        index = index_build.read_index(spark, path)
        run(search.rank_results(search.search(asked, index, stem=stem)))

    jobs = {
        "extract_fields_to_arrays": lambda: run(tokenize_documents(field_documents(pages))),
        "counts_without_stop_words": lambda: run(index_build.page_counts(pages, stem=False)),
        "extract_stop_words_and_stem": lambda: run(stemmed_documents(field_documents(pages))),
        "counts_stemmed": lambda: run(index_build.page_counts(pages)),
        "xml_split_scan": lambda: run(xml.read_pages(spark, dump)),
        "index_build": lambda: index_build.build_index(pages, plain, stem=False),
        "index_build_stemmed": lambda: index_build.build_index(pages, stemmed),
        "index_build_stemmed_large_batches": lambda: index_build.build_index(
            pages, scratch_path(spark, "large"), batch_size=20_000
        ),
        "search_one": lambda: find(one_query, stemmed, True),
        "search_all": lambda: find(queries, stemmed, True),
        "search_all_unstemmed": lambda: find(queries, plain, False),
        "search_one_json": lambda: search.search_job(spark, one_query, stemmed, scratch_path(spark, "hits")),
        "term_lookup_all": lambda: run(search.term_lookup(search.query_terms(queries), index_build.read_index(spark, stemmed))),
        "keyed_write": lambda: keyed.write_keyed_table(field_documents(pages), table),
        "keyed_put": lambda: keyed.put_documents(spark, table, puts),
        "keyed_read": lambda: run(keyed.read_keyed_table(spark, table)),
        "word_count": lambda: run(word_count(tables.spread(documents).select(F.col("text").alias("value")))),
    }
    def timed(job) -> float:
        start = time.time()
        job()
        return round(time.time() - start, 3)

    seconds = {name: min(timed(job), timed(job)) for name, job in jobs.items()}
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "documents": documents.count(),
        "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
