from termfold import values as v
from termfold.operators import counts, documents
from termfold.operators.wordcount import word_count, write_counts

SCHEMA = "Id string, " + ", ".join(f"{field} array<string>" for field in v.FIELDS)
ROWS = [
    ("1", ["a"], ["a", "b", "a"], [], ["c"], None),
    ("2", [], ["b", ""], ["b"], [], ["d", "d"]),
    ("2", ["b"], ["b"], [], [], []),  # a second row of the same document
    ("3", [], [], [], [], []),
]


def test_one_pass_equals_outer_merge(spark):
    words = spark.createDataFrame(ROWS, SCHEMA)
    merged = counts.merge_term_frequencies([counts.term_frequency(words, f) for f in v.FIELDS])
    one_pass = counts.field_term_counts(words).select(merged.columns)
    expected = {
        ("1", "a", 1, 2, 0, 0, 0), ("1", "b", 0, 1, 0, 0, 0), ("1", "c", 0, 0, 0, 1, 0),
        ("2", "b", 1, 2, 1, 0, 0), ("2", "d", 0, 0, 0, 0, 2),
    }
    assert {tuple(row) for row in merged.collect()} == expected
    assert {tuple(row) for row in one_pass.collect()} == expected


def test_merged_rows_are_not_dealt_out_again_for_every_field(spark):
    words = spark.createDataFrame(ROWS, SCHEMA)
    merged = counts.merge_term_frequencies([counts.term_frequency(words, f) for f in v.FIELDS])
    assert "Join" not in merged._jdf.queryExecution().optimizedPlan().toString()


def test_stop_words_can_go_while_counting(spark):
    words = spark.createDataFrame(ROWS, SCHEMA)
    left = {row.Word for row in counts.field_term_counts(words, ["b", "d"]).collect()}
    assert left == {"a", "c"}


def test_one_shuffle_for_all_fields(spark):
    words = spark.createDataFrame(ROWS, SCHEMA)
    plan = counts.field_term_counts(words)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_fields_are_not_evaluated_again_below_the_explode(spark):
    pages = spark.createDataFrame([("1", "A title", "a {{infobox b}} c ==external links== d [[category:e]]")], "Id string, Title string, Text string")
    words = documents.drop_stop_words(documents.tokenize_documents(documents.field_documents(pages)))
    for field in v.FIELDS:
        plan = counts.term_frequency(words, field)._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter (" in line and "regexp_replace" in line], field


def test_word_count_of_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("the cat\tThe  cat \n\n cat's\n")
    counted = word_count(spark.read.text(str(tmp_path)))
    assert {tuple(r) for r in counted.collect()} == {("the", 1), ("The", 1), ("cat", 2), ("cat's", 1)}
    write_counts(counted, str(tmp_path / "out"))
    lines = {row.value for row in spark.read.text(str(tmp_path / "out")).collect()}
    assert lines == {"the\t1", "The\t1", "cat\t2", "cat's\t1"}


def test_documents_of_one_row_are_counted_without_a_shuffle(spark):
    once = [row for row in ROWS if row[0] != "2"] + [(None, ["a", None, "the"], None, [], ["the"], ["a", ""])]
    words = spark.createDataFrame(once, SCHEMA)
    counted = counts.field_term_counts(words, ["the"])
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    expected = {("1", "a", 1, 2, 0, 0, 0), ("1", "b", 0, 1, 0, 0, 0), ("1", "c", 0, 0, 0, 1, 0), (None, "a", 1, 0, 0, 0, 1)}
    assert {tuple(row) for row in counted.collect()} == expected


def test_rows_are_counted_in_runs_and_null_ids_are_one_document(spark, monkeypatch):
    monkeypatch.setattr(counts, "WORDS_TOGETHER", 2)
    rows = [*ROWS, (None, ["x"], [], [], [], []), (None, ["x"], ["x", "y"], [], [], [])]
    words = spark.createDataFrame(rows * 3, SCHEMA)
    merged = counts.merge_term_frequencies([counts.term_frequency(words, f) for f in v.FIELDS])
    found = counts.field_term_counts(words).select(merged.columns)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, merged.collect()), key=str)
