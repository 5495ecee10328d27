"""The jobs as spark-submit starts them."""

import json
import os

import pytest

from termfold import jobs
from termfold.operators import keyed
from termfold.session import saved, scratch_folder, scratch_run, stored

DUMP = """<mediawiki><page><title>Planets</title><id>1</id><revision><text>planets orbit the sun external links nasa</text></revision></page>
<page><title>Cats</title><id>2</id><revision><text>cats sleep external links x [[Category:Animals]]</text></revision></page></mediawiki>
"""


@pytest.fixture
def clean_scratch(spark):
    """Scratch holds after the job what it held before."""
    with scratch_run(spark):
        stored(spark.range(1), "before")
    folder = f"{scratch_folder(spark)}/termfold"
    before = set(os.listdir(folder))
    yield
    assert set(os.listdir(folder)) == before


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    (folder / "dump.xml").write_text(DUMP)
    jobs.run(spark, ["index", "--pages", str(folder / "dump.xml"), "--index", str(folder / "index")])
    return str(folder / "index")


def results(spark, path):
    rows = [json.loads(r.value) for r in spark.read.text(path).collect()]
    return {r["query_id"]: json.loads(r["result"]) for r in rows}


def test_index_and_one_query(spark, index, tmp_path, clean_scratch):
    jobs.run(spark, ["search", "--index", index, "--query", "planet of the suns", "--output", str(tmp_path / "hits")])
    assert [hit["key"] for hit in results(spark, str(tmp_path / "hits"))[0]["results"]] == ["1"]


def test_many_queries(spark, index, tmp_path, clean_scratch):
    asked = spark.createDataFrame([(3, "cats"), (4, "nothing")], "query_id long, query string")
    asked.write.parquet(str(tmp_path / "asked"))
    jobs.run(spark, ["search", "--index", index, "--queries", str(tmp_path / "asked"), "--output", str(tmp_path / "hits")])
    found = results(spark, str(tmp_path / "hits"))
    assert found[3]["results"][0]["key"] == "2" and found[4]["status"] == "error"


def test_index_of_a_sample(spark, tmp_path, clean_scratch):
    (tmp_path / "dump.xml").write_text(DUMP)
    arguments = ["index", "--pages", str(tmp_path / "dump.xml"), "--index", str(tmp_path / "i"), "--sample", "1", "--no-stem"]
    jobs.run(spark, arguments)
    words = {r.Word for r in spark.read.parquet(str(tmp_path / "i" / "primary")).collect()}
    assert "planets" in words and "cats" not in words


def test_put_leaves_only_the_table(spark, tmp_path, clean_scratch):
    path = str(tmp_path / "t")
    keyed.write_keyed_table(spark.createDataFrame([("1", "a")], "Id string, Title string"), path)
    spark.createDataFrame([("1", "b", 1), ("2", "c", 1)], "Id string, Title string, at long").write.parquet(str(tmp_path / "u"))
    jobs.run(spark, ["put", "--table", path, "--updates", str(tmp_path / "u"), "--sequence", "at", "--expire"])
    assert sorted(tuple(r) for r in keyed.read_keyed_table(spark, path).collect()) == [("1", "b"), ("2", "c")]
    assert keyed.table_state(spark, path).version == 2


def test_a_result_is_saved_and_its_intermediate_tables_go(spark, tmp_path, clean_scratch):
    saved(spark, lambda: stored(stored(spark.range(9), "a"), "b"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 9


def test_arguments(spark):
    for wrong in ([], ["search", "--index", "i", "--output", "o"], ["index", "--pages", "p"]):
        with pytest.raises(SystemExit):
            jobs.parser().parse_args(wrong)
