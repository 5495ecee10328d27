"""Ranks, postings, segments, the written index and look-ups in it."""

import bisect
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from termfold import values as v
from termfold.operators import lookup, postings, ranking
from termfold.plans import index_build
from termfold.session import scratch_folder, scratch_run, stored

COUNTS = "Id string, Word string, " + ", ".join(f"{field} long" for field in v.FIELDS)


def term_documents(spark, documents=300, words=40):
    """Every third term-document row belongs to one word."""
    random.seed(7)
    pairs = {(str(d), f"w{random.randrange(words):03d}") for d in range(documents) for _ in range(2)}
    pairs |= {(str(d), "hot") for d in range(documents)}
    rows = [(d, w, *[random.randrange(3) for _ in v.FIELDS]) for d, w in sorted(pairs)]
    return spark.createDataFrame(rows, COUNTS).repartition(4)


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_rank_equals_the_window(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        random.seed(1)
        # group 0 holds more than a third of the rows; many ties in the score
        rows = [(g if random.random() < 0.5 else 0, random.randrange(5), str(i)) for i in range(3000) for g in [i % 9]]
        rows += [(None, 1, "a"), (None, 1, "b")]
        df = spark.createDataFrame(rows, "g int, score int, key string")
        ours = ranking.ranked(df, [F.desc("score"), "key"], within=["g"])
        window = Window.partitionBy("g").orderBy(F.desc("score"), "key")
        theirs = df.withColumn("rank", F.row_number().over(window).cast("long"))
        assert sorted(ours.collect(), key=repr) == sorted(theirs.collect(), key=repr)
        whole = ranking.ranked(df, ["score", "key"])
        theirs = df.withColumn("rank", F.row_number().over(Window.orderBy("score", "key")).cast("long"))
        assert sorted(whole.collect(), key=repr) == sorted(theirs.collect(), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_words_rank_in_byte_order(spark):
    words = ["b", "a", "é", "z", "Z", "\U0001f600", "￮"]
    df = spark.createDataFrame([(w,) for w in words], "Word string")
    ranks = {r.Word: r["rank"] for r in ranking.vocabulary_rank(df).collect()}
    assert sorted(words, key=lambda w: w.encode()) == sorted(words, key=ranks.get)


def test_empty_table_has_no_ranks(spark):
    assert ranking.vocabulary_rank(spark.createDataFrame([], "Word string")).collect() == []


def test_segments_are_bounded_and_whole(spark):
    counts = term_documents(spark)
    whole = postings.inverted_index(counts).collect()
    parts = postings.inverted_index(counts, segment_size=50).collect()
    assert all(row.segment == 0 for row in whole)
    hot = [row for row in parts if row.Word == "hot"]
    assert len(hot) == 6 and max(len(row.Postings) for row in hot) < 100
    for row in whole:
        gathered = sorted(p for part in parts if part.Word == row.Word for p in part.Postings)
        assert gathered == sorted(row.Postings)
        assert [p.doc_id for p in row.Postings] == sorted(p.doc_id for p in row.Postings)


def test_segments_without_a_broadcast(spark):
    counts = term_documents(spark)
    expected = sorted(postings.inverted_index(counts, segment_size=50).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert sorted(postings.inverted_index(counts, segment_size=50).collect()) == expected
        # Neither the look-up of segments nor the building of the lists holds the word in one task.
        frequent = postings.frequent_words(postings.document_frequencies(counts), 50)
        task = F.spark_partition_id().alias("task")
        for table in (postings.with_segment(counts, frequent), postings.inverted_index(counts, segment_size=50)):
            assert table.filter("Word = 'hot'").select(task).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_most_words_may_be_frequent(spark, monkeypatch):
    counts = stored(term_documents(spark), "counts")
    expected = sorted(postings.inverted_index(counts, segment_size=5).collect())
    monkeypatch.setattr(postings, "SALTED_WORDS", 3)
    monkeypatch.setattr(postings, "POSTINGS_PER_TASK", 100)
    frequent = postings.frequent_words(postings.document_frequencies(counts), 5)
    assert frequent.count() > 30
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for threshold in ("10485760", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            index = postings.inverted_index(counts, segment_size=5)
            assert sorted(index.collect()) == expected
            assert index.filter("Word = 'hot'").select(F.spark_partition_id().alias("task")).distinct().count() > 1
            placed = postings.with_segment(counts, frequent)
            assert set(placed.columns) == {*counts.columns, "segment"}
        # Rows are dealt out once for the join and the lists; only the very frequent words are joined once per salt.
        plan = postings.inverted_index(counts, segment_size=5)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY") == 1 and plan.count("Exchange") == 4 and plan.count("Generate") == 1
        others = postings._with_place(counts, frequent)[0]
        assert others.filter("segment > 0 and part = 0").select("Word").distinct().count() > 30
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_posting_lists_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    counts = stored(term_documents(spark), "counts")
    monkeypatch.setattr(postings, "POSTINGS_PER_TASK", 20)
    plan = postings.inverted_index(counts)._jdf.queryExecution().executedPlan().toString()
    assert f", {-(-counts.count() // 20)}), REPARTITION_BY_NUM" in plan


def test_posting_strings(spark):
    rows = [("12", "w", 1, 4, 0, 2, 0), ("31", "w", 0, 1, 0, 0, 0)]
    index = postings.inverted_index(spark.createDataFrame(rows, COUNTS))
    text = postings.encode_postings(index)
    assert text.first().Document_Counts == "12:1-4-0-2-0#31:0-1-0-0-0"
    assert postings.decode_postings(text).select(index.columns).collect() == index.collect()


def test_written_index(spark, tmp_path):
    counts = stored(term_documents(spark), "counts")
    path = str(tmp_path / "index")
    index_build.write_index(counts, path, batch_size=10, segment_size=50)
    index = index_build.read_index(spark, path)
    primary, secondary = index.primary, index.secondary
    words = sorted({row.Word for row in counts.collect()})
    assert {row.Word: row.batch for row in primary.collect()} == {w: i // 10 for i, w in enumerate(words)}
    assert {row.batch: row.first_word for row in secondary.collect()} == dict(enumerate(words[::10]))
    as_built = postings.inverted_index(counts, 50)
    assert sorted(primary.select(as_built.columns).collect()) == sorted(as_built.collect())

    text = str(tmp_path / "text")
    index_build.export_secondary_text(secondary, text)
    assert [row.value for row in spark.read.text(text).collect()] == words[::10]

    # A smaller index replaces all batches of the larger one.
    index_build.write_index(counts.filter("Word = 'hot'"), path, batch_size=10)
    index = index_build.read_index(spark, path)
    primary, secondary = index.primary, index.secondary
    assert primary.count() == 1 and secondary.count() == 1


def test_large_batches_and_frequent_words_are_written_by_many_tasks(spark, tmp_path):
    counts = stored(term_documents(spark), "counts")
    path = str(tmp_path / "index")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index_build.write_index(counts, path, batch_size=1000, segment_size=20, postings_per_file=40)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len([f for f in os.listdir(f"{path}/primary/batch=0") if f.endswith(".parquet")]) == 4
    primary = index_build.read_index(spark, path).primary
    as_built = postings.inverted_index(counts, 20)
    assert sorted(primary.select(as_built.columns).collect()) == sorted(as_built.collect())


def test_long_lists_are_not_unpacked_together(spark, tmp_path):
    """A reader makes arrays of all rows of a row group, up to 4096; a file may hold ten million postings."""
    zeros = ", ".join(f"0L AS {field.lower()}" for field in v.FIELDS[1:])
    posting = f"struct(cast(x * 1000003 AS string) AS doc_id, x AS {v.FIELDS[0].lower()}, {zeros})"
    lists = spark.range(20).selectExpr(
        "0 AS batch", "0L AS chunk", "0L AS part", "concat('w', id) AS Word", "0 AS segment",
        f"transform(sequence(id, id + 49999), x -> {posting}) AS Postings",
    )
    index_build.write_primary(lists, f"{tmp_path}/primary")
    (file,) = (tmp_path / "primary" / "batch=0").glob("*.parquet")
    groups = pq.ParquetFile(file).metadata
    groups = [groups.row_group(i) for i in range(groups.num_row_groups)]
    postings_of = [max(group.column(i).num_values for i in range(group.num_columns)) for group in groups]
    assert sum(postings_of) == 20 * 50_000 and max(postings_of) <= 500_000
    written = index_build.read_index(spark, str(tmp_path)).primary
    assert written.select("Word", "Postings").exceptAll(lists.select("Word", "Postings")).isEmpty() and written.count() == 20


def test_chunks_hold_consecutive_words_of_bounded_postings(spark):
    rows = [(f"w{i:02d}", 3 if i != 5 else 1000, 0) for i in range(20)]
    words = spark.createDataFrame(rows, "Word string, documents long, batch int")
    chunks = [r.chunk for r in index_build.with_chunk(words, 10).orderBy("Word").collect()]
    assert chunks == sorted(chunks) and max(chunks.count(c) for c in set(chunks)) <= 4


def test_no_batch_is_empty(spark, tmp_path):
    rows = [("1", f"w{i:02d}", 1, 0, 0, 0, 0) for i in range(20)]
    counts = spark.createDataFrame(rows, COUNTS)
    path = str(tmp_path / "index")
    index_build.write_index(counts, path, batch_size=10)
    assert sorted(d for d in os.listdir(f"{path}/primary") if d.startswith("batch")) == ["batch=0", "batch=1"]
    row = index_build.index_statistics(counts, 10).first()
    assert (row.words, row.planned_batches, row.written_batches) == (20, 3, 2)


def test_build_leaves_only_the_index(spark, tmp_path):
    pages = spark.createDataFrame([("1", "Cats", "cats {{infobox big}} run external links x [[category:y]]")],
                                  "Id string, Title string, Text string")
    with scratch_run(spark):
        stored(pages, "before")
    before = set(os.listdir(f"{scratch_folder(spark)}/termfold"))
    index_build.build_index(pages, str(tmp_path / "i"))
    assert set(os.listdir(f"{scratch_folder(spark)}/termfold")) == before
    primary = index_build.read_index(spark, str(tmp_path / "i")).primary
    counts = {row.Word: tuple(row.Postings[0])[1:] for row in primary.collect()}
    assert counts == {"cat": (1, 0, 0, 0, 0), "run": (0, 1, 0, 0, 0), "big": (0, 0, 0, 1, 0),
                      "x": (0, 0, 0, 0, 1), "y": (0, 0, 1, 0, 0)}


def test_lookup_equals_bisection(spark):
    random.seed(3)
    first = sorted({"".join(random.choices("abc", k=random.randrange(1, 5))) for _ in range(60)})
    first = [w for w in first if w > "ab"]
    words = sorted({"".join(random.choices("abcd", k=random.randrange(1, 6))) for _ in range(400)})
    secondary = spark.createDataFrame(list(enumerate(first)), "batch int, first_word string")
    expected = {w: bisect.bisect_right(first, w) - 1 for w in words}
    expected = {w: b for w, b in expected.items() if b >= 0}
    assert len(expected) < len(words)
    table = spark.createDataFrame([(w,) for w in words + words[:50]], "Word string")
    assert lookup.secondary_lookup(table, secondary).count() == len(expected)
    assert dict(tuple(r) for r in lookup.secondary_lookup(table, secondary).collect()) == expected
    assert lookup.locate_words(secondary, words) == expected


def test_lookup_in_an_empty_index_finds_nothing(spark):
    secondary = spark.createDataFrame([], "batch int, first_word string")
    words = spark.createDataFrame([("a",)], "Word string")
    assert lookup.secondary_lookup(words, secondary).collect() == []
    assert lookup.locate_words(secondary, ["a"]) == {}


def test_decoded_lists_are_not_tested_for_rows_first(spark):
    import __spark_entry__ as contract

    plan = contract.decode_postings(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter (" in line and "split(" in line]
