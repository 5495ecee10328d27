"""Row numbers over a whole table, without bringing it to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termfold import values as v
from termfold.session import stored

# monotonically_increasing_id() keeps the partition above bit 33, the row below.
ROW_BITS = 33


def range_sorted(df: DataFrame, *order: Column | str) -> DataFrame:
    """Range-partitioned and sorted rows, stored with their slice and place in it.

    The slices follow each other in sort order. They are written out because a
    second evaluation could sample other slice bounds.
    """
    place = F.monotonically_increasing_id()
    return stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns(
            {
                "slice": F.shiftright(place, ROW_BITS).cast("int"),
                "place": place.bitwiseAND(F.lit((1 << ROW_BITS) - 1)),
            }
        ),
        "sorted",
    )


def ranked(
    df: DataFrame,
    order: Sequence[Column | str],
    within: Sequence[str] = (),
    name: str = "rank",
) -> DataFrame:
    """``row_number()`` over (partition by ``within`` order by ``order``), from 1.

    A window would sort each group in a single task, the whole table if
    ``within`` is empty. Here a large group spreads over many slices: one small
    table of group sizes per slice gives every slice its starting number.
    """
    within = list(within)
    rows = range_sorted(df, *within, *order)
    runs = rows.groupBy(*within, "slice").agg(
        F.count("*").alias("run_rows"), F.min("place").alias("run_start")
    )
    # One row per slice and group in it; with no groups that is one row per slice.
    earlier = (
        Window.partitionBy(*within).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = stored(
        runs.select(
            *within,
            "slice",
            "run_start",
            F.coalesce(F.sum("run_rows").over(earlier), F.lit(0)).alias("rows_before"),
        ),
        "rows_before",
    )
    number = F.col("rows_before") + F.col("place") - F.col("run_start") + 1
    row, run = rows.alias("row"), before.alias("run")
    same_run = F.col("row.slice") == F.col("run.slice")
    for column in within:
        same_run &= F.col(f"row.{column}").eqNullSafe(F.col(f"run.{column}"))
    kept = [F.col(f"row.{column}") for column in df.columns]
    return row.join(run, same_run).select(*kept, number.alias(name))


def vocabulary_rank(words: DataFrame) -> DataFrame:
    """Rank of each distinct word (``Word`` must be unique) in byte order."""
    return ranked(words, ["Word"], name="rank")


def with_batch(ranked_words: DataFrame, batch_size: int = v.BATCH_SIZE) -> DataFrame:
    """Batch number: ``batch_size`` consecutive words per batch, from 0."""
    batch = F.floor((F.col("rank") - 1) / batch_size).cast("int")
    return ranked_words.withColumn("batch", batch)
