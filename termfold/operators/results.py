"""Hits of a query as the texts of JSON lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from termfold.session import ship_package

# Hits that a task gets, a few full documents: whatever writes them may hold all their texts at once.
HITS_PER_TASK = 500_000


def differs(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before."""
    if pa.types.is_nested(column.type):  # has no codes
        values = column.to_pylist()
        return np.array([value != before for before, value in zip(values, values[1:])], dtype=bool)
    return np.diff(column.dictionary_encode("encode").indices.to_numpy()) != 0


def run_starts(keys: pa.RecordBatch) -> np.ndarray:
    """Places of rows that differ from the row before; the first row is one."""
    return np.append(0, np.flatnonzero(np.any([differs(column) for column in keys.columns], axis=0)) + 1)


def joined_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(query_id, document, results)`` from ``(query_id, document, hit)`` in order: the hits of each run, with commas.

    A run may go on over many batches. Only the one at hand is kept.
    """

    def made(keys: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*keys.columns, pa.array(texts, kind)], names=["query_id", "document", "results"])

    begun, parts = None, []  # the last row's key, and texts of its run
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, hits = batch.select(["query_id", "document"]), batch.column("hit")
        kind = hits.type  # of short or of large texts, as the session has it
        met = pa.Table.from_batches([keys] if begun is None else [begun, keys]).combine_chunks().to_batches()[0]
        starts = run_starts(met)
        # The key in front has no hit in this batch, so the run that it began may have none.
        cuts = np.append(np.maximum(starts - (len(met) - len(keys)), 0), len(keys))
        runs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), hits)
        texts = pc.binary_join(runs, pa.scalar(",", kind)).to_pylist()
        parts += texts[:1] if cuts[1] else []
        if len(texts) > 1:
            yield made(met.take(pa.array(starts[:-1])), [",".join(parts), *texts[1:-1]])
            parts = texts[-1:]
        begun = met.slice(len(met) - 1)
    if begun is not None:
        yield made(begun, [",".join(parts)])


def result_lists(hits: DataFrame, size: int) -> DataFrame:
    """``(query_id, document, results)`` from ``size`` rows ``(query_id, document, rank, key, score)``: a document's hits by rank, as JSON.

    Rows are dealt out by document and sorted, which spills where memory is short, and joined as they come. An aggregate
    that collects them holds the hits of up to 128 documents in every task, before and after it deals them out, before
    it turns to sorting.
    """
    ship_package(hits.sparkSession)
    rows = (
        hits.repartition(max(1, -(-size // HITS_PER_TASK)), "query_id", "document")
        .sortWithinPartitions("query_id", "rank", "key", "score")
        .select("query_id", "document", F.to_json(F.struct("key", "score")).alias("hit"))
    )
    schema = StructType([rows.schema["query_id"], StructField("document", LongType()), StructField("results", StringType())])
    return rows.mapInArrow(joined_runs, schema)
