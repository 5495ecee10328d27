import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from termfold import values as v
from termfold.operators import postings, results
from termfold.plans import index_build, search
from termfold.session import scratch_folder, scratch_run, stored

PAGES = [
    ("1", "Planets", "lead {{Infobox planet sun}} planets orbit the sun external links nasa [[Category:Space]]"),
    ("2", "Sun", "the sun is a star. sun! external links esa [[Category:Space]]"),
    ("3", "Cats", "cats sleep external links x [[Category:Animals]]"),
]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "i")
    pages = spark.createDataFrame(PAGES, "Id string, Title string, Text string")
    index_build.build_index(pages, path, batch_size=2)
    return index_build.read_index(spark, path)


def queries(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, query string")


def scores(df):
    return {(row.query_id, row.key): row.score for row in df.collect()}


def test_query_terms(spark):
    terms = search.query_terms(queries(spark, "The planets of the Sun, sun", "of the"), stem=False)
    assert {tuple(row) for row in terms.collect()} == {(0, "planets", 1), (0, "sun", 2)}
    stemmed = search.query_terms(queries(spark, "planets' PLANET re"))
    assert {tuple(row) for row in stemmed.collect()} == {(0, "planet", 2)}


def test_scores(spark, index):
    found = scores(search.search(queries(spark, "sun", "planets sun sun", "AAA", "cats x"), index))
    sun_1 = 1 + 50 + 50  # once in the body, once in the infobox, base score
    sun_2 = 500 + 2 + 50
    planet_1 = 500 + 1 + 50 + 50
    assert found == {
        (0, "1"): sun_1, (0, "2"): sun_2,
        (1, "1"): planet_1 + 2 * sun_1, (1, "2"): 2 * sun_2,
        (3, "3"): 500 + 1 + 50 + 50 + 50,
    }


def test_many_words_take_the_join_with_the_same_result(spark, index, monkeypatch):
    asked = queries(spark, "sun", "planets sun sun", "AAA", "cats x 0 zzz")
    expected = scores(search.search(asked, index))
    monkeypatch.setattr(search, "PRUNED_WORDS", 0)
    assert scores(search.search(asked, index)) == expected


def test_lists_are_rewritten_once_for_all_queries(spark, index, monkeypatch):
    asked = stored(search.query_terms(queries(spark, "planets sun sun", "sun cats", "cats sun"), stem=True), "terms")
    expected = sorted(map(tuple, postings.encode_postings(search.term_lookup(asked, index)).collect()))
    assert len(expected) > len({row[1] for row in expected})
    for pruned in (search.PRUNED_WORDS, 0):
        monkeypatch.setattr(search, "PRUNED_WORDS", pruned)
        given = []

        def rewritten(rows):
            given.append(rows.select("Word", "segment").collect())
            return postings.encode_postings(rows)

        found = search.term_lookup(asked, index, lists=rewritten)
        assert found.columns == ["query_id", "Word", "repeats", "segment", "Document_Counts"]
        assert sorted(map(tuple, found.collect())) == expected
        (rows,) = given
        assert sorted(rows) == sorted({(row[1], row[3]) for row in expected})
        # The strings are read by the join, not made above it for every query.
        assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_other_words_leave_the_scan_before_lists_move(spark, index, monkeypatch):
    """Also where the wanted words are too many to be sent to every task."""
    monkeypatch.setattr(search, "PRUNED_WORDS", 0)
    asked = queries(spark, "sun", "planets sun sun", "AAA", "cats x 0 zzz")
    expected = scores(search.search(asked, index))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = search.term_lookup(search.query_terms(asked), index)
        plan = found._jdf.queryExecution().executedPlan().toString()
        scan = plan[plan.index("Postings#"):]
        # From the scan upwards: the hash join by word bucket, and only then an exchange of rows with their lists.
        below = [line for line in scan.splitlines() if "Postings#" in line or "BroadcastHashJoin" in line or "Exchange" in line]
        semi = next(i for i, line in enumerate(below) if "LeftSemi" in line)
        moved = next(i for i, line in enumerate(below) if "Exchange hashpartitioning(batch" in line)
        assert moved < semi  # plans are printed from the top
        assert "Exchange hashpartitioning" not in "".join(below[semi + 1 : semi + 2])
        assert scores(search.search(asked, index)) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_manifest_names_every_file_once(spark, index):
    rows = index.manifest.collect()
    assert sum(r.rows for r in rows) == index.primary.count()
    assert len({r.file for r in rows}) == len(rows)
    for row in rows:
        words = sorted(r.Word for r in index.files([row.file]).collect())
        assert (words[0], words[-1], len(words)) == (row.first_word, row.last_word, row.rows)
    assert index.files([]).collect() == []


def test_a_search_opens_only_located_files(spark, index, monkeypatch):
    asked = queries(spark, "cats")
    terms = search.query_terms(asked)
    opened = search.term_lookup(terms, index).inputFiles()
    files = {r.file for r in index.manifest.where("first_word <= 'cat' AND last_word >= 'cat'").collect()}
    assert {f.split("/primary/")[-1] for f in opened if "/primary/" in f} == files and len(files) == 1
    expected = scores(search.search(asked, index))
    monkeypatch.setattr(search, "NAMED_FILES", 0)
    assert scores(search.search(asked, index)) == expected


def test_a_search_job_leaves_only_its_result(spark, index, tmp_path):
    with scratch_run(spark):
        stored(index.secondary, "before")
    folder = f"{scratch_folder(spark)}/termfold"
    before = set(os.listdir(folder))
    out = str(tmp_path / "out")
    search.search_job(spark, queries(spark, "sun", "nothing"), index.path, out)
    assert set(os.listdir(folder)) == before
    found = {json.loads(r.value)["query_id"]: json.loads(json.loads(r.value)["result"]) for r in spark.read.text(out).collect()}
    assert [hit["key"] for hit in found[0]["results"]] == ["2", "1"] and found[1]["status"] == "error"


def test_only_the_batches_of_the_words_are_read(spark, index):
    terms = search.query_terms(queries(spark, "cats"))
    plan = search.term_lookup(terms, index)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(Word), EqualTo(Word,cat)" in plan or "In(Word, [cat])" in plan


def test_results_as_json(spark, index):
    asked = queries(spark, 'the "sun"', "nothing")
    ranked = search.rank_results(search.search(asked, index))
    documents = {row.query_id: json.loads(row.json) for row in search.result_documents(asked, ranked).collect()}
    assert documents[0] == {
        "string": 'the "sun"', "status": "success",
        "results": [{"key": "2", "score": 552}, {"key": "1", "score": 101}],
    }
    assert documents[1] == {"string": "nothing", "status": "error", "message": v.NOTHING_FOUND}


def test_long_results_come_in_parts(spark, index):
    asked = queries(spark, "sun space cats")
    ranked = search.rank_results(search.search(asked, index))
    parts = search.result_documents(asked, ranked, results_per_document=2).orderBy("document").collect()
    keys = [[hit["key"] for hit in json.loads(row.json)["results"]] for row in parts]
    order = [row.key for row in ranked.orderBy("rank").collect()]
    assert keys == [order[:2], order[2:]]


def test_hits_are_not_collected_by_the_tasks(spark, index, monkeypatch):
    """An aggregate that collects holds the hits of up to 128 documents in a task, however long they are."""
    asked = queries(spark, "sun space cats", "nothing", "sun")
    ranked = stored(search.rank_results(search.search(asked, index)), "ranked")
    monkeypatch.setattr(results, "HITS_PER_TASK", 2)
    plan = search.result_documents(asked, ranked)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
    # Five hits: as many tasks as these take, which are not put together again.
    assert ranked.count() == 5 and "3), REPARTITION_BY_NUM" in plan


def test_runs_are_joined_as_they_come():
    def batch(*rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())],
            names=["query_id", "document", "hit"],
        )

    given = [
        batch((None, 0, "a"), ("p", 0, "b")), batch(("p", 0, "c"), ("p", 0, "d")), batch(),
        batch(("p", 0, "e"), ("p", 1, "f"), ("q", 1, "g")), batch(("r", 1, "h")),
    ]
    read = []

    def batches():
        for i, rows in enumerate(given):
            read.append(i)
            yield rows

    found = [(len(read), tuple(row.values())) for made in results.joined_runs(batches()) for row in made.to_pylist()]
    # With each document, how many batches were read by then.
    assert found == [
        (1, (None, 0, "a")), (4, ("p", 0, "b,c,d,e")), (4, ("p", 1, "f")), (5, ("q", 1, "g")), (5, ("r", 1, "h")),
    ]
    assert list(results.joined_runs(iter([]))) == []


def test_query_ids_may_be_structs(spark):
    asked = spark.sql("SELECT struct(id % 2 AS a, 'x' AS b) AS query_id, concat('text ', id) AS query FROM range(3)").where("query <> 'text 2'")
    ranked = spark.sql("SELECT struct(id % 2 AS a, 'x' AS b) AS query_id, cast(id AS string) AS key, id AS score, (id DIV 2) + 1 AS rank FROM range(8)")
    found = search.result_documents(asked, ranked, results_per_document=3).collect()
    keys = {(r.query_id.a, r.document): [hit["key"] for hit in json.loads(r.json)["results"]] for r in found}
    assert keys == {(0, 0): ["0", "2", "4"], (0, 1): ["6"], (1, 0): ["1", "3", "5"], (1, 1): ["7"]}


@pytest.mark.parametrize("rows, large", [(1, "false"), (2, "false"), (3, "true"), (10_000, "false")])
def test_documents_of_odd_queries_over_several_batches(spark, rows, large):
    asked = spark.createDataFrame(
        [("a", 'say "x"\n\\ñ }'), ("b", None), ("c", "none"), (None, "null id"), ("d", "twice"), ("d", "again")], "query_id string, query string"
    )
    hits = [(q, f'k"{r}', 10 * r, r) for q, n in [("a", 5), ("b", 2), ("d", 1), (None, 3), ("not asked", 2)] for r in range(1, n + 1)]
    # Ranks may have gaps: what is left of a query can be its second document alone.
    hits += [("e", "late", None, 4), ("f", None, 7, 5)]
    asked = asked.unionByName(spark.createDataFrame([("e", "E"), ("f", "F")], asked.schema))
    ranked = spark.createDataFrame(hits[::-1], "query_id string, key string, score long, rank long")
    conf = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.useLargeVarTypes": large}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        found = search.result_documents(asked, ranked, results_per_document=3).collect()
    finally:
        for name in conf:
            spark.conf.unset(name)
    lists = {}
    for q, key, score, rank in sorted(hits, key=lambda hit: hit[3]):
        hit = {name: value for name, value in (("key", key), ("score", score)) if value is not None}
        lists.setdefault((q, (rank - 1) // 3), []).append(hit)
    expected = []
    for q, text in asked.collect():
        string = {} if text is None else {"string": text}
        of_query = sorted(d for asked_id, d in lists if asked_id == q and q is not None)
        documents = max(of_query, default=0) + 1
        expected += [(q, d, documents, json.dumps(string | {"status": "success", "results": lists[q, d]}, separators=(",", ":"), ensure_ascii=False)) for d in of_query]
        if not of_query:
            expected.append((q, 0, 1, json.dumps(string | {"status": "error", "message": v.NOTHING_FOUND}, separators=(",", ":"), ensure_ascii=False)))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_result_file_and_listing(spark, index, tmp_path, capsys):
    asked = search.single_query(spark, "sun")
    ranked = search.rank_results(search.search(asked, index))
    search.write_results(search.result_documents(asked, ranked, results_per_document=1), str(tmp_path / "out"))
    lines = [json.loads(row.value) for row in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted((x["query_id"], x["document"], x["documents"]) for x in lines) == [(0, 0, 2), (0, 1, 2)]
    assert all(json.loads(x["result"])["status"] == "success" for x in lines)
    listed = search.listing(queries(spark, "sun", "nothing"), ranked).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in listed] == [(0, 1, "2 552"), (0, 2, "1 101"), (1, 0, v.NOTHING_FOUND)]
    search.show_results(ranked)
    search.show_results(ranked.filter("false"))
    assert v.NOTHING_FOUND in capsys.readouterr().out


def test_weights_can_be_set(spark, index):
    weights = {**v.WEIGHTS, "title": 1, "base": 0}
    found = scores(search.search(queries(spark, "sun"), index, weights=weights))
    assert found == {(0, "1"): 51, (0, "2"): 3}


def test_hits_are_not_dealt_out_by_query_for_the_texts_of_the_queries(spark, index):
    asked = queries(spark, "sun", "nothing", "cats")
    ranked = search.rank_results(search.search(asked, index))
    listed = search.listing(asked, ranked)
    documents = search.result_documents(asked, ranked, results_per_document=1)
    for result in (listed, documents):
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftOuter" not in plan
    assert sorted(r.query_id for r in listed.where("rank = 0").collect()) == [1]
    assert sorted((r.query_id, r.document, r.documents) for r in documents.collect()) == [(0, 0, 2), (0, 1, 2), (1, 0, 1), (2, 0, 1)]


def test_rows_are_dealt_out_before_scores_are_added_up(spark, index):
    found = search.term_lookup(search.query_terms(queries(spark, "sun planets")), index)
    plan = search.score_documents(found)._jdf.queryExecution().executedPlan().toString()
    # Plans are printed from the top: both halves of the sum stand above the one exchange by document.
    by_document = [line for line in plan.splitlines() if "Exchange hashpartitioning(query_id" in line and "key#" in line]
    assert len(by_document) == 1
    assert plan.index("partial_sum(score") < plan.index(by_document[0])
