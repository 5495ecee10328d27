import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import plain
from termfold.llm import jaccard, langid, lines, mixing, pieces
from termfold.session import stored

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def by_id(rows):
    return {r.doc_id: r for r in rows}


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_duplicates", "mixing", "encoding"]


def test_each_stage_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where(F.length("text") < 4000)
    odd = [(9001, None, "en", "src0", None), (9002, "123", "en", "src1", 3), (9003, "The and of that to be.", None, None, 22)]
    docs = stored(docs.select(COLUMNS).union(spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars int")), "docs")
    before = by_id(docs.collect())
    stages = dict(corpus_pipeline.STAGES)

    def step(name, table):
        out = stored(stages[name](spark, table, SF_DIR), name)
        return out, by_id(out.collect())

    table, found = step("language", docs)
    assert table.columns == COLUMNS
    learned = plain.profiles([(r.text, r.lang) for r in before.values() if not plain.held_out(r.doc_id)], langid.PROFILE_SIZE)
    kept = {i for i, r in before.items() if plain.nearest(r.text, learned, langid.PROFILE_SIZE)[1] >= corpus_pipeline.LEAST_SCORE}
    assert set(found) == kept and {9001, 9002}.isdisjoint(kept) and len(kept) > 0.95 * len(before)
    assert all(found[i] == before[i] for i in kept)

    before = found
    table, found = step("line_dedup", table)
    expected = dict(zip(before, plain.dedup_lines([(i, r.text) for i, r in before.items()], lines.NEAR_WORDS, corpus_pipeline.COPY_SHARE)))
    expected = {i: text for i, text in expected.items() if text.strip()}
    assert table.columns == COLUMNS and {i: r.text for i, r in found.items()} == expected
    assert all(r.n_chars == len(r.text) for r in found.values())

    before = found
    table, found = step("near_duplicates", table)
    groups = plain.near_duplicates([(i, r.text) for i, r in before.items()])
    assert table.columns == COLUMNS and set(found) == {i for i, _, c in groups if c == i}
    assert all(found[i] == before[i] for i in found)

    assert len(found) < len(before)
    before = found
    dealt = mixing.mix(table).collect()
    cells = {}
    for r in dealt:
        cells[r.source, r.lang, r.topic] = cells.get((r.source, r.lang, r.topic), 0) + r.tokens
    weight = plain.rake(cells, [plain.evened(cells, place, mixing.TEMPERATURE) for place in range(3)])
    chance = plain.probabilities(cells, weight, mixing.KEEP)
    drawn = {r.doc_id: r.u for r in table.select("doc_id", mixing.draw(F.col("doc_id"), F.col("text")).alias("u")).collect()}
    table, found = step("mixing", table)
    assert table.columns == COLUMNS
    assert set(found) == {r.doc_id for r in dealt if drawn[r.doc_id] < chance[r.source, r.lang, r.topic]}

    before = found
    _, found = step("encoding", table)
    own = pieces.Pieces(pieces.read_model())
    assert set(found) == set(before)
    for i, r in found.items():
        assert own.decoded(r.tokens) == r.text == before[i].text and r.lossless


def test_run_takes_all_stages(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns == [*COLUMNS, "tokens", "n_tokens", "lossless"]
    assert rows.where("not lossless").count() == 0 and rows.count() > 50
    assert rows.where("text is null or not text rlike '[^ \\t\\n]'").count() == 0


LARGER = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test tables")
def test_near_duplicates_go_whole(spark):
    """Line dedup leaves copies for the stage that judges whole documents: it drops what the operator names on raw texts."""
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    named = {r.doc_id for r in jaccard.near_duplicates(docs.select("doc_id", "text")).where("component_id <> doc_id").collect()}
    language = stored(stages["language"](spark, docs, LARGER), "language")
    deduped = stored(stages["line_dedup"](spark, language, LARGER), "line_dedup")
    kept = {r.doc_id for r in stages["near_duplicates"](spark, deduped, LARGER).collect()}
    before = {r.doc_id for r in deduped.collect()}
    assert len(named) > 50
    assert len(named & kept) <= 0.05 * len(named)
    assert len(before - kept) > 0.8 * len(named & before)
    assert len((before - kept) - named) <= 0.02 * len(before)


CLASHING = "doc_id long, text string, lang string, source string, n_chars bigint, score string, kept string, topic int, n_lines string, lang_pred string, Weight string"


def clashing(spark, rows):
    return spark.createDataFrame([(*row, len(row[1] or ""), "s", "k", 7, "n", "l", "w") for row in rows], CLASHING)


def test_columns_of_the_same_names_come_through(spark, monkeypatch):
    # The near-duplicate operator sees two columns only; here none of its groups matters.
    monkeypatch.setattr(jaccard, "near_duplicates", lambda docs: docs.selectExpr("doc_id", "doc_id AS component_id"))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where(F.length("text") < 2000).limit(40).collect()
    table = stored(clashing(spark, [(r.doc_id, r.text, r.lang, r.source) for r in docs]), "clashing")
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, table, SF_DIR), name)
        extra = out.select("score", "kept", "topic", "n_lines", "lang_pred", "Weight").distinct().collect()
        assert [tuple(r) for r in extra] == [("s", "k", 7, "n", "l", "w")], name
        assert out.columns[: len(table.columns)] == table.columns
        table = out
    assert table.columns[len(table.columns) - 3 :] == ["tokens", "n_tokens", "lossless"]


def test_run_on_empty_and_repeated_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, some in (("empty", docs.limit(0)), ("repeated", docs.where("doc_id < 30").union(docs.where("doc_id < 30")))):
        some.write.parquet(str(tmp_path / name / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).collect() == []
    rows = corpus_pipeline.run(spark, str(tmp_path / "repeated")).collect()
    twice = {}
    for r in rows:
        twice.setdefault((r.doc_id, r.text), []).append(r.tokens)
    assert rows and all(len(t) == 2 and t[0] == t[1] for t in twice.values())
    assert len({t for _, t in twice}) == len(twice)


def test_lines_are_taken_from_a_text_once(spark, capsys):
    rows = [(i, f"line of text number {i}\nthe same long line in all of them\n", "en", "web", 0) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    corpus_pipeline.line_dedup(spark, docs, "").explain()
    assert capsys.readouterr().out.count("ArrowEvalPython [_without") == 1
