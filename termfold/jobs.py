"""Jobs for spark-submit: build an index, search it, put documents into a keyed table.

    spark-submit --py-files termfold.zip termfold/jobs.py index --pages dump.xml --index out
    spark-submit --py-files termfold.zip termfold/jobs.py search --index out --query "planets of the sun" --output hits
    spark-submit --py-files termfold.zip termfold/jobs.py put --table documents --updates puts.parquet

Every job writes its result and deletes what it stored on the way. On a cluster ``spark.checkpoint.dir`` names the shared
folder for that.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from termfold import values as v
from termfold.operators import keyed
from termfold.operators.documents import sample_pages
from termfold.plans import index_build, search
from termfold.session import ship_package
from termfold.sources import xml


def index_job(
    spark: SparkSession, pages: str, index: str, sample: int | None = None, batch_size: int = v.BATCH_SIZE, **counting
) -> None:
    """Index the pages of an XML dump; ``sample`` takes the pages of lowest ids only."""
    documents = xml.read_pages(spark, pages)
    if sample is not None:
        documents = sample_pages(documents, sample)
    index_build.build_index(documents, index, batch_size=batch_size, **counting)


def search_text(spark: SparkSession, index: str, query: str, output: str, **searching) -> None:
    search.search_job(spark, search.single_query(spark, query), index, output, **searching)


def search_table(spark: SparkSession, index: str, queries: str, output: str, **searching) -> None:
    """All queries of a Parquet table ``(query_id, query)``."""
    search.search_job(spark, spark.read.parquet(queries), index, output, **searching)


def put_job(spark: SparkSession, table: str, updates: str, sequence: str = "sequence", expire: bool = False) -> None:
    keyed.put_documents(spark, table, spark.read.parquet(updates), sequence=sequence)
    if expire:
        keyed.expire(spark, table)


def parser() -> argparse.ArgumentParser:
    whole = argparse.ArgumentParser(prog="termfold")
    jobs = whole.add_subparsers(dest="job", required=True)
    index = jobs.add_parser("index")
    index.add_argument("--pages", required=True)
    index.add_argument("--index", required=True)
    index.add_argument("--sample", type=int)
    index.add_argument("--batch-size", type=int, default=v.BATCH_SIZE)
    index.add_argument("--no-stem", dest="stem", action="store_false")
    find = jobs.add_parser("search")
    find.add_argument("--index", required=True)
    find.add_argument("--output", required=True)
    find.add_argument("--no-stem", dest="stem", action="store_false")
    asked = find.add_mutually_exclusive_group(required=True)
    asked.add_argument("--query")
    asked.add_argument("--queries")
    put = jobs.add_parser("put")
    put.add_argument("--table", required=True)
    put.add_argument("--updates", required=True)
    put.add_argument("--sequence", default="sequence")
    put.add_argument("--expire", action="store_true")
    return whole


def run(spark: SparkSession, arguments: Sequence[str] | None = None) -> None:
    ship_package(spark)
    asked = vars(parser().parse_args(arguments))
    job = asked.pop("job")
    if job == "index":
        index_job(spark, **asked)
    elif job == "put":
        put_job(spark, **asked)
    elif asked.get("query") is not None:
        asked.pop("queries")
        search_text(spark, **asked)
    else:
        asked.pop("query")
        search_table(spark, **asked)


if __name__ == "__main__":
    run(SparkSession.builder.appName("termfold").getOrCreate())
