import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from termfold.operators import keyed

CELLS = "Id string, Title string, Text string, Categories string, Infobox string, External_Links string"
SAMPLE = [
    ("1", "Heron", "a wading bird", "birds wetlands", "legs long", "herons example"),
    ("2", "Basalt", "a dark rock", "rocks", "colour grey", "basalt example"),
]


def test_upsert_keeps_the_last_value_of_every_cell(spark):
    table = spark.createDataFrame(SAMPLE, CELLS)
    puts = spark.createDataFrame(
        [
            ("2", 1, "first", None, None, None, None),
            ("2", 2, None, "second", None, None, None),
            ("2", 3, "third", None, None, None, None),
            ("3", 1, "new", None, None, None, None),
        ],
        "Id string, sequence long, " + CELLS.removeprefix("Id string, "),
    )
    rows = {row.Id: tuple(row)[1:] for row in keyed.upsert(table, puts).collect()}
    assert rows == {
        "1": SAMPLE[0][1:],
        "2": ("third", "second", *SAMPLE[1][3:]),
        "3": ("new", None, None, None, None),
    }


STONES = "Id string, Stone string, Weight long"


def files_of(path):
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def stones_table(spark, tmp_path, n=200, **sizes):
    stones = [(f"{i:04d}", f"stone {i}", i) for i in range(n)]
    path = str(tmp_path / "stones")
    keyed.write_keyed_table(spark.createDataFrame(stones, STONES).repartition(3), path, **sizes)
    return path, stones


def scanned(spark, path, version=None):
    return sorted(tuple(r) for r in keyed.read_keyed_table(spark, path, version).collect())


def put(spark, path, *rows, **sizes):
    keyed.put_documents(spark, path, spark.createDataFrame(list(rows), STONES + ", at long"), sequence="at", **sizes)


def test_a_put_writes_only_its_rows(spark, tmp_path):
    path, stones = stones_table(spark, tmp_path)
    before = files_of(tmp_path)
    for _ in range(2):  # the same puts again change nothing
        put(spark, path, ("0002", None, 31, 1), ("new", "agate", 39, 1), ("new", None, 40, 2), (None, "lost", 1, 1))
        assert scanned(spark, path) == sorted([s for s in stones if s[0] != "0002"] + [("0002", "stone 2", 31), ("new", "agate", 40)])
    after = files_of(tmp_path)
    assert {f: after[f] for f in before} == before
    assert spark.read.parquet(*[f for f in after if f not in before]).count() == 4
    keyed.put_documents(spark, path, spark.createDataFrame([], STONES + ", at long"), sequence="at")
    assert files_of(tmp_path) == after


def test_readers_see_one_version(spark, tmp_path):
    path, stones = stones_table(spark, tmp_path)
    reading = keyed.read_keyed_table(spark, path)
    put(spark, path, ("0000", "marl", None, 1))
    keyed.compact(spark, path)
    assert sorted(tuple(r) for r in reading.collect()) == stones == scanned(spark, path, 1)
    assert scanned(spark, path) == scanned(spark, path, 2) == [("0000", "marl", 0), *stones[1:]]


def test_later_puts_win_cell_by_cell_whatever_their_sequence_number(spark, tmp_path):
    path, stones = stones_table(spark, tmp_path)
    put(spark, path, ("0001", "first", 1, 9), ("x", "a", None, 9))
    put(spark, path, ("0001", "second", None, 1), ("x", None, 2, 1))
    found = {r[0]: r[1:] for r in scanned(spark, path)}
    assert found["0001"] == ("second", 1) and found["x"] == ("a", 2)
    keyed.compact(spark, path)
    assert {r[0]: r[1:] for r in scanned(spark, path)} == found


def test_regions_are_kept_with_the_table_and_grow(spark, tmp_path):
    path, stones = stones_table(spark, tmp_path, rows_per_region=50)
    assert keyed.table_state(spark, path).regions == 4
    more = [(f"{i:04d}", "more", i, 1) for i in range(150, 350)]
    put(spark, path, *more, rows_per_region=50)  # more than the share: merged at once
    state = keyed.table_state(spark, path)
    assert (state.rows, state.regions, state.logs) == (350, 7, [])
    assert scanned(spark, path) == stones[:150] + [m[:3] for m in more]
    # Sorted by key in regions that follow each other.
    files = [sorted(r.Id for r in spark.read.parquet(f).collect()) for f in files_of(tmp_path) if state.base in f]
    files = sorted(f for f in files if f)
    assert len(files) == 7 and sum(files, []) == sorted(sum(files, []))
    # A put without sizes of its own does not mind how the table was written.
    put(spark, path, ("0003", "chalk", None, 1), ("0400", "slate", 1, 1))
    assert len(scanned(spark, path)) == 351


def test_conditions_on_the_key_reach_base_and_logs(spark, tmp_path):
    path, stones = stones_table(spark, tmp_path, rows_per_region=50)
    put(spark, path, ("0002", "talc", None, 1), ("9", "new", 1, 1))
    some = keyed.read_keyed_table(spark, path).where("Id >= '0100' AND Id < '0103'")
    assert sorted(tuple(r) for r in some.collect()) == stones[100:103]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(Id,0100)") >= 3


def test_many_logs_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "MOST_LOGS", 2)
    path, stones = stones_table(spark, tmp_path)
    for i in range(3):
        put(spark, path, ("0000", f"put {i}", i, 1))
    assert keyed.table_state(spark, path).logs == []
    assert scanned(spark, path)[0] == ("0000", "put 2", 2)


def test_expire_leaves_the_newest_version(spark, tmp_path):
    path, stones = stones_table(spark, tmp_path)
    put(spark, path, ("0000", "marl", None, 1))
    keyed.compact(spark, path)
    put(spark, path, ("0001", "tuff", None, 1))
    expected = scanned(spark, path)
    keyed.expire(spark, path)
    assert scanned(spark, path) == expected
    state = keyed.table_state(spark, path)
    assert sorted(p.name for p in (tmp_path / "stones").iterdir()) == sorted([state.base, *state.logs, "versions"])
    with pytest.raises(FileNotFoundError):
        keyed.read_keyed_table(spark, path, 1)


def test_empty_missing_and_replaced_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        keyed.read_keyed_table(spark, path)
    keyed.write_keyed_table(spark.createDataFrame([], STONES), path)
    assert scanned(spark, path) == []
    put(spark, path, ("1", "agate", 1, 1))
    assert scanned(spark, path) == [("1", "agate", 1)]
    keyed.write_keyed_table(spark.createDataFrame([("2", "flint", 2)], STONES), path)
    assert scanned(spark, path) == [("2", "flint", 2)]


def test_large_logs_are_joined_without_sending_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "SENT_BYTES", 0)
    path, stones = stones_table(spark, tmp_path)
    put(spark, path, ("0000", "marl", None, 1), ("z", "new", 1, 1))
    assert scanned(spark, path) == [("0000", "marl", 0), *stones[1:], ("z", "new", 1)]


def test_puts_of_one_sequence_number_have_a_defined_winner(spark):
    puts = spark.createDataFrame([("1", "b", 1), ("1", "c", 1), ("1", "a", 1)], "Id string, t string, at long")
    assert keyed.last_puts(puts, "Id", ["t"], "at").first().t == "c"


def test_table_is_created_once_written_and_scanned(spark, tmp_path):
    table = spark.createDataFrame(SAMPLE, CELLS)
    path = str(tmp_path / "t")
    keyed.create_if_missing(spark, "keyed_documents", table.schema, path)
    table.write.insertInto("keyed_documents")
    keyed.create_if_missing(spark, "keyed_documents", table.schema, path)
    assert sorted(spark.table("keyed_documents").collect()) == sorted(table.collect())
    spark.sql("DROP TABLE keyed_documents")


def test_sink_passes_format_options_and_mode(spark, tmp_path):
    stones = spark.createDataFrame([Row(Id="7", Stone="flint", Weight=3), Row(Id="8", Stone="chalk", Weight=1)])
    path = str(tmp_path / "p")
    keyed.keyed_sink(stones, path, format="json", compression="gzip")
    assert list((tmp_path / "p").glob("*.json.gz"))
    keyed.keyed_sink(stones, path, format="json")
    assert spark.read.json(path).count() == 4
    keyed.keyed_sink(stones, path, format="json", mode="overwrite")
    assert spark.read.json(path).count() == 2


def test_cells_as_bytes(spark):
    row = keyed.encoded(spark.createDataFrame([("1", "é", 3)], "Id string, t string, n int")).first()
    assert [bytes(cell) for cell in row] == [b"1", "é".encode(), b"3"]


def test_regions_of_long_rows_hold_fewer_of_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "BYTES_PER_REGION", 10_000)
    path = str(tmp_path / "long")
    rows = spark.createDataFrame([(f"{i:04d}", "x" * 996) for i in range(100)], "Id string, Text string")
    keyed.write_keyed_table(rows, path)
    state = keyed.table_state(spark, path)
    assert (state.rows, state.regions) == (100, 10)
    keyed.put_documents(spark, path, rows.withColumn("sequence", F.lit(1)))
    keyed.compact(spark, path)
    assert keyed.table_state(spark, path).regions == 10
    assert sorted(keyed.read_keyed_table(spark, path).collect()) == sorted(rows.collect())
