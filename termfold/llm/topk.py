"""Exact top-k search by inner product with block-at-a-time pruning.

Every component of a vector is a term, its integer value the term's weight. Vectors are kept in blocks of
neighbouring rows, each with a forward index (the vectors themselves) and the largest and smallest weight of every
term. For a query, a block's bound is the sum over terms of query weight times the block's largest weight (smallest,
for a negative query weight). Blocks are scored in the order of their bounds until the next bound lies below the
k-th score found; ties at the k-th score are still scored, as a smaller id could win.

The index is a table of blocks, written once. Queries are sent to the tasks in batches of at most
``QUERY_BATCH_BYTES``; every batch is scored against all blocks in one distributed pass. A task returns at most k rows
for each query, so nothing grows with the square of the input beyond the stated query set.

Defined results: null vectors and vectors with null, NaN or infinite components take no part, nor do rows without an
id. Shorter vectors count as padded with zeros, so an empty vector scores 0 with every other. Rows that share an id are
candidates of their own; as a query an id counts once, with its smallest vector. A query's own rows (same id) are
never its results. Scores outside the range of a long stop at its ends. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termfold.session import stored

BLOCK_ROWS = 64
CHUNK_ROWS = 8192
QUERY_BATCH_BYTES = 32 << 20
#: Query rows whose bounds are computed together in a task.
QUERY_SLICE = 512
SCALE = 256
_EXACT = float(1 << 53)

_BLOCKS = "ids binary, vectors binary, largest binary, smallest binary, dims int, rows int"


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as double; null if the vector takes no part."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(~F.coalesce(broken, F.lit(False)), whole)


def _padded(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row vectors as a matrix padded with zeros, and their lengths."""
    sizes = np.diff(np.asarray(lists.offsets, np.int64))
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = np.zeros((len(sizes), int(sizes.max(initial=0))))
    matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = flat
    return matrix, sizes


def _neighbours(matrix: np.ndarray, rows: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Rows halved on their widest component until ``size`` or fewer are left: tight blocks."""
    if len(rows) <= size:
        yield rows
        return
    part = matrix[rows]
    widest = int((part.max(0) - part.min(0)).argmax()) if part.shape[1] else 0
    order = rows[np.argsort(part[:, widest], kind="stable")] if part.shape[1] else rows
    half = (len(rows) // size + 1) // 2 * size
    yield from _neighbours(matrix, order[:half], size)
    yield from _neighbours(matrix, order[half:], size)


def build_blocks(df: DataFrame, id_column: str = "vec_id", vector: str = "vector") -> DataFrame:
    """The index: a row for each block of :data:`BLOCK_ROWS` rows that lie near each other in the input.

    Made in one pass without a shuffle. ``vector`` holds whole numbers as doubles, see :func:`scaled`.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(start, CHUNK_ROWS)
                ids = part.column(0).to_numpy()
                matrix, _ = _padded(part.column(1))
                rows = []
                for members in _neighbours(matrix, np.arange(len(ids)), BLOCK_ROWS):
                    members = members[np.argsort(ids[members], kind="stable")]
                    block = matrix[members]
                    rows.append(
                        {
                            "ids": ids[members].astype(np.int64).tobytes(),
                            "vectors": block.tobytes(),
                            "largest": block.max(0).tobytes(),
                            "smallest": block.min(0).tobytes(),
                            "dims": block.shape[1],
                            "rows": len(members),
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_BLOCKS)

    used = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("vector"))
    return used.where("id is not null and vector is not null").mapInArrow(task, _BLOCKS)


_ARROW_BLOCKS = pa.schema(
    [(n, pa.binary()) for n in ("ids", "vectors", "largest", "smallest")]
    + [("dims", pa.int32()), ("rows", pa.int32())]
)


def _fitted(matrix: np.ndarray, dims: int) -> np.ndarray:
    """The first ``dims`` columns, zeros where there are none."""
    if matrix.shape[1] >= dims:
        return matrix[:, :dims]
    return np.pad(matrix, ((0, 0), (0, dims - matrix.shape[1])))


def _products(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in doubles while they fit, else with Python's integers."""
    most = np.abs(queries).max(initial=0) * np.abs(block).max(initial=0) * max(1, block.shape[1])
    if most < _EXACT:
        return (queries @ block.T).astype(np.int64)
    exact = _whole(queries).dot(_whole(block).T)
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _whole(matrix: np.ndarray) -> np.ndarray:
    return np.frompyfunc(int, 1, 1)(matrix)


class _Best:
    """The k best (score, id) of each of some queries."""

    def __init__(self, n: int, k: int):
        self.scores = np.full((n, k), np.iinfo(np.int64).min)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.found = np.zeros((n, k), bool)
        self.k = k

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, valid: np.ndarray) -> None:
        scores = np.concatenate((self.scores[rows], scores), axis=1)
        ids = np.concatenate((self.ids[rows], np.broadcast_to(ids, (len(rows), len(ids)))), axis=1)
        found = np.concatenate((self.found[rows], valid), axis=1)
        by_id = np.argsort(ids, axis=1, kind="stable")
        scores, ids, found = (np.take_along_axis(x, by_id, 1) for x in (scores, ids, found))
        # Highest first without negating: the lowest long has no opposite.
        order = np.argsort(~scores, axis=1, kind="stable")
        scores, ids, found = (np.take_along_axis(x, order, 1) for x in (scores, ids, found))
        order = np.argsort(~found, axis=1, kind="stable")[:, : self.k]
        self.scores[rows], self.ids[rows], self.found[rows] = (
            np.take_along_axis(x, order, 1) for x in (scores, ids, found)
        )

    def least(self, rows: np.ndarray) -> np.ndarray:
        """The k-th score, minus infinity while there are fewer than k."""
        return np.where(self.found[rows, -1], self.scores[rows, -1].astype(np.float64), -np.inf)


def _search_blocks(blocks: list[dict], query_ids: np.ndarray, queries: np.ndarray, best: _Best, rows: np.ndarray) -> None:
    """Score ``blocks`` for the queries ``rows`` block by block in the order of each query's own bounds."""
    dims = max(b["dims"] for b in blocks)
    q = _fitted(queries[rows], dims)
    largest = np.stack([np.pad(b["largest"], (0, dims - b["dims"])) for b in blocks])
    smallest = np.stack([np.pad(b["smallest"], (0, dims - b["dims"])) for b in blocks])
    bounds = np.maximum(q, 0) @ largest.T + np.minimum(q, 0) @ smallest.T
    # A margin for bounds beyond what doubles hold exactly.
    bounds += 1e-9 * (np.abs(q) @ np.maximum(np.abs(largest), np.abs(smallest)).T)
    order = np.argsort(-bounds, axis=1, kind="stable")
    alive = np.arange(len(rows))
    for step in range(len(blocks)):
        chosen = order[alive, step]
        alive = alive[bounds[alive, chosen] >= best.least(rows[alive])]
        if not len(alive):
            return
        chosen = order[alive, step]
        by_block = np.argsort(chosen, kind="stable")
        cuts = np.flatnonzero(np.diff(chosen[by_block])) + 1
        for members in np.split(by_block, cuts):
            block = blocks[chosen[members[0]]]
            asked = rows[alive[members]]
            scores = _products(q[alive[members], : block["dims"]], block["vectors"])
            best.add(asked, scores, block["ids"], query_ids[asked][:, None] != block["ids"])


def search(blocks: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows of ``blocks`` for each row ``(id, vector)`` of ``queries``.

    One pass over the blocks for each :data:`QUERY_BATCH_BYTES` of queries.
    """
    spark = blocks.sparkSession
    once = queries.where("id is not null and vector is not null").groupBy("id").agg(F.min("vector").alias("vector"))
    sizes = once.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dims")).first()
    each = max(1, QUERY_BATCH_BYTES // (8 * (sizes.dims or 1) + 16))
    passes = max(1, -(-sizes.n // each))
    dealt = once.withColumn("pass", F.pmod(F.xxhash64("id"), F.lit(passes)))
    found = [_pass(spark, blocks, dealt.where(F.col("pass") == i), k) for i in range(passes)]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return every.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pass(spark, blocks: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    asked = queries.select("id", "vector").toArrow().combine_chunks()
    ids = asked.column(0).to_numpy().astype(np.int64)
    lists = asked.column(1).combine_chunks()
    matrix = _padded(lists)[0] if len(ids) else np.zeros((0, 0))
    sent = spark.sparkContext.broadcast((ids, matrix))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, vectors = sent.value
        best = _Best(len(query_ids), k)
        for batch in batches:
            part = [_opened(row) for row in batch.to_pylist()]
            for start in range(0, len(query_ids), QUERY_SLICE):
                rows = np.arange(start, min(start + QUERY_SLICE, len(query_ids)))
                _search_blocks(part, query_ids, vectors, best, rows)
        row, column = np.nonzero(best.found)
        yield pa.record_batch(
            [pa.array(query_ids[row]), pa.array(best.ids[row, column]), pa.array(best.scores[row, column])],
            ["query_id", "vec_id", "score"],
        )

    return blocks.mapInArrow(task, "query_id long, vec_id long, score long")


def _opened(row: dict) -> dict:
    dims = row["dims"]
    numbers = {name: np.frombuffer(row[name], np.float64) for name in ("vectors", "largest", "smallest")}
    numbers["vectors"] = numbers["vectors"].reshape(row["rows"], dims)
    return numbers | {"ids": np.frombuffer(row["ids"], np.int64), "dims": dims}


def op1_exact_topk(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    whole = rows.select(F.col("vec_id").alias("id"), scaled(F.col("embedding")).alias("vector"))
    blocks = stored(build_blocks(whole, "id"), "vector_blocks")
    return search(blocks, whole.where(F.col("id") % 50 == 0), 5)


#: The same by comparing every query with every row.
OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
