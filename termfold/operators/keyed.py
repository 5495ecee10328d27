"""Document table keyed by ``Id``: create, put, scan, binary export.

A keyed table is a folder of three kinds of things:

- a *base*: Parquet files of rows sorted by key, cut into regions of about ``rows_per_region`` rows, or fewer where rows are
  long (``BYTES_PER_REGION``). The number of regions is kept with the table and grows with it; file statistics prune a range of keys to its regions;
- *logs*: one folder for each put, which holds the put cells and nothing else;
- *versions*: one row of JSON for each state, naming the base and the logs that make it up.

A put writes its own rows and a version. Readers take the newest version and merge its logs into the base as they read, so
they see the table before or after a put, never in between: files that a version names do not change, and a version
appears by a rename. When the logs have grown to a share of the base they are merged into a new base, whose regions
follow the new number of rows. One writer at a time, as in any table of files without a catalog.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termfold import values as v
from termfold.session import delete_folder, scratch_run, stored

DOCUMENT_CELLS = list(v.FIELDS)
ROWS_PER_REGION = 1_000_000
# Bytes of a region's cells, whatever its rows: one task sorts and writes a region.
BYTES_PER_REGION = 128 << 20
# Logs are merged into the base when there are more than this, or when their rows are this share of the base's.
MOST_LOGS = 16
LOG_SHARE = 0.25
# Put cells of at most so many bytes are sent to all tasks of a read instead of shuffling the base.
SENT_BYTES = 32 << 20

STATE = "base string, logs array<string>, key string, cells array<string>, rows long, regions int, log_rows long, log_bytes long"


def create_if_missing(spark: SparkSession, table: str, schema: StructType, path: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION '{path}'")


def keyed_sink(
    df: DataFrame, path: str | None = None, format: str = "parquet", mode: str = "append", **options: str
) -> None:
    """Write a keyed table through any DataFrame sink; by default rows are added to what is there.

    A wide-column store's connector is chosen by ``format`` with its own options
    (row-key column, column family, table); Parquet needs only a path.
    """
    df.write.format(format).options(**options).mode(mode).save(path)


def last_puts(updates: DataFrame, key: str, cells: list[str], sequence: str) -> DataFrame:
    """One row per key: every cell holds the last value that was put, nulls put nothing.

    Of values put with one sequence number the largest counts.
    """
    latest = [
        F.max_by(F.col(cell), F.when(F.col(cell).isNotNull(), F.struct(sequence, cell))).alias(cell)
        for cell in cells
    ]
    return updates.groupBy(key).agg(*latest)


def upsert(
    table: DataFrame,
    updates: DataFrame,
    key: str = "Id",
    cells: list[str] = DOCUMENT_CELLS,
    sequence: str = "sequence",
) -> DataFrame:
    """The table after all puts: new keys added, put cells replaced, others kept.

    Repeated puts of one key are brought down to one row first, map-side, so the
    join sees each key once per side and cannot be skewed by a much-written key.
    """
    puts = last_puts(updates, key, cells, sequence)
    old, new = table.alias("old"), puts.alias("new")
    merged = [F.coalesce(F.col(f"new.{cell}"), F.col(f"old.{cell}")).alias(cell) for cell in cells]
    return old.join(new, key, "full_outer").select(key, *merged)


def table_state(spark: SparkSession, path: str, version: int | None = None) -> Row:
    """The newest version of a keyed table, or a given one."""
    try:
        states = spark.read.schema(f"{STATE}, version long").json(f"{path}/versions")
    except AnalysisException:
        raise FileNotFoundError(f"no keyed table at {path}") from None
    if version is not None:
        states = states.where(F.col("version") == version)
    newest = states.orderBy(F.desc("version")).first()
    if newest is None:
        raise FileNotFoundError(f"no keyed table at {path}, or not of this version")
    return newest


def _add_version(spark: SparkSession, path: str, version: int, **state) -> None:
    row = spark.createDataFrame([Row(**state)], STATE)
    row.coalesce(1).write.mode("append").json(f"{path}/versions/version={version}")


def _bytes(columns: list[str]) -> Column:
    return sum([F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns], F.lit(0).cast("long"))


def _write_base(rows: DataFrame, folder: str, key: str, rows_per_region: int) -> tuple[int, int]:
    """Write stored rows sorted by key; the numbers of rows and of regions."""
    size = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(_bytes(rows.columns)), F.lit(0)).alias("bytes")).first()
    regions = max(1, -(-size.rows // rows_per_region), -(-size.bytes // BYTES_PER_REGION))
    rows.repartitionByRange(regions, key).sortWithinPartitions(key).write.parquet(folder)
    return size.rows, regions


def write_keyed_table(df: DataFrame, path: str, key: str = "Id", rows_per_region: int = ROWS_PER_REGION) -> None:
    """Write a table that ``put_documents`` can update, or a version of it that replaces all rows. Keys are unique."""
    spark = df.sparkSession
    with scratch_run(spark):
        base = f"base-{uuid.uuid4().hex}"
        count, regions = _write_base(stored(df, "keyed_rows"), f"{path}/{base}", key, rows_per_region)
    try:
        version = table_state(spark, path).version + 1
    except FileNotFoundError:
        version = 1
    cells = [c for c in df.columns if c != key]
    _add_version(spark, path, version, base=base, logs=[], key=key, cells=cells, rows=count, regions=regions, log_rows=0, log_bytes=0)


def _logged(spark: SparkSession, path: str, state: Row) -> DataFrame:
    """One row for each key of the logs: the cells put last, and whether the base lacks the key."""
    logs = spark.read.parquet(*[f"{path}/{log}" for log in state.logs])
    # Of one put a key has one row, so the put's number orders them.
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("put"))).alias(c) for c in state.cells]
    return logs.groupBy(state.key).agg(*last, F.first("fresh").alias("fresh"))


def read_keyed_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """All rows, with the put cells; of an earlier version as long as ``expire`` has not deleted its files.

    Conditions on the key reach the files of base and logs.
    """
    state = table_state(spark, path, version)
    base = spark.read.parquet(f"{path}/{state.base}").select(state.key, *state.cells)
    if not state.logs:
        return base
    puts = _logged(spark, path, state)
    if state.log_bytes <= SENT_BYTES:
        puts = F.broadcast(puts)
    old, new = base.alias("old"), puts.alias("new")
    merged = [F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c) for c in state.cells]
    known = old.join(new, state.key, "left").select(state.key, *merged)
    return known.unionByName(_logged(spark, path, state).where("fresh").drop("fresh"))


def put_documents(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    sequence: str = "sequence",
    cells: list[str] | None = None,
    rows_per_region: int = ROWS_PER_REGION,
) -> None:
    """Put cells into a keyed table; see ``last_puts`` for several puts of one key. A row without a key puts nothing.

    Writes the rows that are put and a version. ``cells`` names the columns that are put, by default all of the table's
    that ``updates`` has. The same puts can be applied again, so a run that failed is repeated.
    """
    with scratch_run(spark):
        state = table_state(spark, path)
        key = state.key
        put = [c for c in (cells or state.cells) if c in updates.columns and c in state.cells]
        puts = stored(last_puts(updates.where(F.col(key).isNotNull()), key, put, sequence), "puts")
        asked = puts.agg(F.count("*").alias("rows"), F.sum(_bytes(puts.columns)).alias("bytes"), F.min(key).alias("low"), F.max(key).alias("high")).first()
        if not asked.rows:
            return
        base = spark.read.parquet(f"{path}/{state.base}")
        # Only the base's regions with keys of this put are read, and of them the keys.
        there = base.where(F.col(key).between(asked.low, asked.high)).select(key).join(puts, key, "left_semi")
        there = stored(there.withColumn("there", F.lit(True)), "known_keys")
        absent = [F.lit(None).cast(base.schema[c].dataType).alias(c) for c in state.cells if c not in put]
        number = state.version + 1
        rows = puts.join(there, key, "left").select(
            key, *[F.col(c).cast(base.schema[c].dataType).alias(c) for c in put], *absent,
            F.lit(number).cast("long").alias("put"), F.col("there").isNull().alias("fresh"),
        )
        log = f"log-{uuid.uuid4().hex}"
        rows.select(key, *state.cells, "put", "fresh").sortWithinPartitions(key).write.parquet(f"{path}/{log}")
    changed = {
        "logs": [*state.logs, log], "log_rows": state.log_rows + asked.rows, "log_bytes": state.log_bytes + (asked.bytes or 0),
    }
    _add_version(spark, path, number, **{k: x for k, x in state.asDict().items() if k != "version"} | changed)
    if len(changed["logs"]) > MOST_LOGS or changed["log_rows"] > LOG_SHARE * max(state.rows, rows_per_region):
        compact(spark, path, rows_per_region)


def compact(spark: SparkSession, path: str, rows_per_region: int = ROWS_PER_REGION) -> None:
    """Merge the logs into a new base, with as many regions as its rows need. Readers of the old version go on."""
    state = table_state(spark, path)
    if not state.logs:
        return
    base = f"base-{uuid.uuid4().hex}"
    with scratch_run(spark):
        # Stored, as a range partitioning evaluates its input twice.
        merged = stored(read_keyed_table(spark, path, state.version), "merged_documents")
        count, regions = _write_base(merged, f"{path}/{base}", state.key, rows_per_region)
    _add_version(
        spark, path, state.version + 1, base=base, logs=[], key=state.key, cells=state.cells, rows=count, regions=regions,
        log_rows=0, log_bytes=0,
    )


def expire(spark: SparkSession, path: str) -> None:
    """Delete what only versions before the newest name. No reader of those may be at work."""
    states = spark.read.schema(f"{STATE}, version long").json(f"{path}/versions")
    newest = table_state(spark, path)
    used = {newest.base, *newest.logs}
    # As many rows as there were puts since the last call.
    old = states.where(F.col("version") < newest.version).collect()
    for state in old:
        delete_folder(spark, f"{path}/versions/version={state.version}")
    for folder in {folder for state in old for folder in (state.base, *state.logs)} - used:
        delete_folder(spark, f"{path}/{folder}")


def encoded(df: DataFrame) -> DataFrame:
    """All columns as UTF-8 bytes, as byte-oriented stores keep them."""
    return df.select([F.encode(F.col(c).cast("string"), "utf-8").alias(c) for c in df.columns])
