"""The search job: any number of queries in one plan."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termfold import values as v
from termfold.functions import scoring, stemming, tokens
from termfold.operators.lookup import locate_words, secondary_lookup
from termfold.operators.ranking import ranked
from termfold.operators.results import result_lists
from termfold.plans.index_build import Index
from termfold.session import scratch_run, stored

# Up to this many distinct words are looked up one by one before the index is read.
PRUNED_WORDS = 500
# Up to this many files are read by name.
NAMED_FILES = 2000
# Values of the hash by which other words' rows leave the scan: the bound of what is sent to all tasks.
WORD_BUCKETS = 1 << 20
# Hits per result document. A query with more gets several documents.
RESULTS_PER_DOCUMENT = 100_000


def single_query(spark: SparkSession, text: str) -> DataFrame:
    return spark.createDataFrame([(0, text)], "query_id long, query string")


def query_terms(queries: DataFrame, stem: bool = True, stemmer: str = "extended") -> DataFrame:
    """``(query_id, Word, repeats)`` from ``(query_id, query)``; repeats count twice in the score."""
    words = tokens.query_words(F.col("query"))
    if stem:
        words = stemming.stem_words(words, stemmer)
    return (
        queries.select("query_id", F.explode(words).alias("Word"))
        .groupBy("query_id", "Word")
        .agg(F.count("*").alias("repeats"))
    )


def word_bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(WORD_BUCKETS)).cast("int")


def _files_of(index: Index, located: dict[str, int]) -> list[str] | None:
    """Files that can hold one of the located words; None if there are too many to name."""
    of_batch = defaultdict(list)
    for word, batch in located.items():
        of_batch[batch].append(word)
    rows = index.manifest.where(F.col("batch").isin(sorted(of_batch))).limit(NAMED_FILES + 1).collect()
    if len(rows) > NAMED_FILES:
        return None
    return sorted(r.file for r in rows if any(r.first_word <= w <= r.last_word for w in of_batch[r.batch]))


def _rewritten(rows: DataFrame, lists: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """Index rows as ``lists`` makes them: dealt out, as one file can hold most of them, and stored, as a join would make them anew for each match."""
    return stored(lists(rows.repartition("Word", "segment")), "found_lists") if lists else rows


def few_words(words: list[str], terms: DataFrame, index: Index, lists: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Postings of words in hand. The manifest names the files of their batches; words are pushed down to the scan."""
    located = locate_words(index.secondary, words)
    files = _files_of(index, located)
    if files is None:
        rows = index.primary.where(F.col("batch").isin(sorted(set(located.values()))))
    else:
        rows = index.files(files)
    # A few hundred words and the queries that ask for them: the smaller side, but known to be so only at run time.
    return _rewritten(rows.where(F.col("Word").isin(sorted(located))), lists).join(terms, "Word")


def many_words(terms: DataFrame, index: Index, lists: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Postings of any number of words.

    The batch column prunes the scan at run time. Rows of other words in those batches leave the scan by a hash of the
    word, of which there are at most :data:`WORD_BUCKETS`, before the exact join moves any posting list.
    """
    located = secondary_lookup(terms, index.secondary)
    placed = stored(terms.join(located, "Word"), "placed_terms")
    # Always true, but pruning at run time needs a comparison on the smaller side.
    placed = placed.filter(F.col("batch") >= 0)
    asked = F.broadcast(placed.select(word_bucket(F.col("Word")).alias("word_bucket")).distinct())
    rows = index.primary.withColumn("word_bucket", word_bucket(F.col("Word")))
    rows = rows.join(asked, "word_bucket", "left_semi").drop("word_bucket")
    if lists:
        # Rows of other words that share a hash are not rewritten.
        rows = _rewritten(rows.join(placed.select("batch", "Word").distinct(), ["batch", "Word"], "left_semi"), lists)
    return rows.join(placed, ["batch", "Word"])


def term_lookup(terms: DataFrame, index: Index, lists: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``(query_id, Word, repeats, segment, Postings)`` of all terms in the index.

    Words are looked up in the secondary index first, so that only their batches are read. ``lists`` (for example
    ``encode_postings``) rewrites the posting list of a word once, however many queries ask for it.
    """
    words = [row.Word for row in terms.select("Word").distinct().limit(PRUNED_WORDS + 1).collect()]
    found = few_words(words, terms, index, lists) if len(words) <= PRUNED_WORDS else many_words(terms, index, lists)
    return found.select("query_id", "Word", "repeats", "segment", *[c for c in found.columns if c in ("Postings", "Document_Counts")])


def score_documents(found: DataFrame, weights: dict[str, int] = v.WEIGHTS) -> DataFrame:
    """``(query_id, key, score)``: scores summed over the terms of a query, any term matches.

    A posting list names a document once, so adding up before the shuffle brings rows of one file hardly down, but keeps
    them all in that task's memory. Rows are dealt out first.
    """
    hits = found.select("query_id", "repeats", F.explode("Postings").alias("posting"))
    score = scoring.posting_score(F.col("posting"), weights) * F.col("repeats")
    return (
        hits.select("query_id", F.col("posting.doc_id").alias("key"), score.alias("score"))
        .repartition("query_id", "key")
        .groupBy("query_id", "key")
        .agg(F.sum("score").alias("score"))
    )


def search(
    queries: DataFrame,
    index: Index,
    stem: bool = True,
    stemmer: str = "extended",
    weights: dict[str, int] = v.WEIGHTS,
) -> DataFrame:
    """Scores of every document that holds a term of a query."""
    terms = stored(query_terms(queries, stem, stemmer), "query_terms")
    return score_documents(term_lookup(terms, index), weights)


def rank_results(scores: DataFrame) -> DataFrame:
    """``(query_id, key, score, rank)``: best first, ties by key.

    Scores are stored first, as a range partitioning evaluates its input twice.
    """
    return ranked(stored(scores, "scores"), [F.desc("score"), "key"], within=["query_id"])


def result_documents(
    queries: DataFrame,
    ranked_scores: DataFrame,
    results_per_document: int = RESULTS_PER_DOCUMENT,
) -> DataFrame:
    """``(query_id, document, documents, json)``: all hits of a query, best first.

    ``document`` numbers the ``documents`` of a query from 0. Hits are cut into documents of bounded size by rank, so a query that matches
    a third of all pages never becomes one value. A query without hits gets one
    error document.
    """
    number = F.floor((F.col("rank") - 1) / results_per_document)
    sizes = ranked_scores.groupBy("query_id").agg((F.max(number) + 1).alias("documents"), F.count("*").alias("hits"))
    # One row per query that found something, read by two joins.
    sizes = stored(sizes, "result_sizes")
    hits = result_lists(
        ranked_scores.select("query_id", number.alias("document"), "rank", "key", "score"),
        sizes.agg(F.sum("hits")).first()[0] or 0,
    )
    text = F.col("query").alias("string")
    # The object up to its closing brace, as to_json writes it, and the list that is text already.
    head = F.to_json(F.struct(text, F.lit("success").alias("status")))
    head = head.substr(F.lit(1), F.length(head) - 1)
    success = F.concat(head, F.lit(',"results":['), F.col("results"), F.lit("]}"))
    error = F.to_json(
        F.struct(text, F.lit("error").alias("status"), F.lit(v.NOTHING_FOUND).alias("message"))
    )
    # The documents stand on the left: a merge join keeps the rows of a key that come from the right.
    answers = hits.join(sizes, "query_id").join(queries, "query_id").select("query_id", "document", "documents", success.alias("json"))
    return answers.unionByName(
        _unanswered(queries, sizes).select(
            "query_id", F.lit(0).cast("long").alias("document"), F.lit(1).cast("long").alias("documents"), error.alias("json")
        )
    )


def _unanswered(queries: DataFrame, answered: DataFrame) -> DataFrame:
    """Queries without a row in ``answered``.

    A left join of queries and hits would find them too, but it can only send the hits to all tasks, never the queries:
    it brings all hits of a query to one task and sorts them there.
    """
    return queries.join(answered.select("query_id"), "query_id", "left_anti")


def write_results(documents: DataFrame, path: str) -> None:
    """One line of JSON for each result document: query, its number and the number of all, and the document."""
    line = F.to_json(F.struct("query_id", "document", "documents", F.col("json").alias("result")))
    documents.select(line.alias("value")).write.mode("overwrite").text(path)


def listing(queries: DataFrame, ranked_scores: DataFrame) -> DataFrame:
    """``(query_id, rank, line)``: each query's hits as lines in order, or the line that nothing was found."""
    asked = queries.select("query_id")
    line = F.concat_ws(" ", "key", F.col("score").cast("string"))
    found = ranked_scores.join(asked, "query_id").select("query_id", F.col("rank").cast("long").alias("rank"), line.alias("line"))
    nothing = _unanswered(asked, ranked_scores.select("query_id").distinct())
    return found.unionByName(
        nothing.select("query_id", F.lit(0).cast("long").alias("rank"), F.lit(v.NOTHING_FOUND).alias("line"))
    )


def show_results(ranked_scores: DataFrame, rows: int = 20) -> None:
    """Print the best hits of each query in order, or a line that nothing was found."""
    best = ranked_scores.orderBy("query_id", "rank")
    if best.isEmpty():
        print(v.NOTHING_FOUND)
    else:
        best.show(rows, truncate=False)


def search_job(
    spark: SparkSession,
    queries: DataFrame,
    index_path: str,
    output: str,
    results_per_document: int = RESULTS_PER_DOCUMENT,
    **searching,
) -> None:
    """Search a written index for ``(query_id, query)`` and write the result documents; nothing else is left behind."""
    with scratch_run(spark):
        ranked_scores = stored(rank_results(search(queries, Index(spark, index_path), **searching)), "ranked_results")
        write_results(result_documents(queries, ranked_scores, results_per_document), output)
