"""Hard-negative mining with L2AP-style threshold joins.

For every anchor: its nearest rows of the same label (the positives), and for each positive the nearest rows of other
labels whose score lies in a window below the positive's.

The index is a table of blocks. Components are put in the order of their energy over all rows and cut into slabs; a block
keeps one posting run per slab and every row's norm over the slabs that follow. For a threshold, a row is indexed up to
the slab from which on its norm can no longer reach the threshold with any of the queries at hand (their thresholds lie
close together): the dimensions behind it are covered by that bound and left out. Partial scores are accumulated slab by
slab over the rows still indexed; rows drop out when partial score and remaining norms (Cauchy-Schwarz) stay below all
thresholds, and pairs that reach theirs at the end are scored in full.

Thresholds start high and are lowered for the windows that have not filled: first the best score that an anchor finds in a
bounded seed of the index (:data:`SEED_BLOCKS`), then the score that fills its window in the seed, and where the seed has
too few rows the window's own lower end. A window filled by rows above a threshold holds the best rows there are, so the
seed decides the cost and never the result. Anchors are handled in batches of :data:`BATCH_BYTES`; a batch's results are
written before the next begins, and a task returns no more rows than a window holds.

Defined results: rows with a null id, label or vector, or with a null, NaN or infinite component, take no part. Shorter
vectors count as padded with zeros. Rows that share an id are candidates of their own; as an anchor an id counts once,
with its smallest label and vector. Rows with an anchor's id are never among its results. Ties go to the smaller id, then
are any of the equal rows. Scores outside the range of a long stop at its ends. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termfold.llm.topk import scaled
from termfold.session import scratch_path, stored

BLOCK_ROWS = 2048
SLAB = 8
BATCH_BYTES = 32 << 20
#: Blocks of the index from which the first thresholds are taken.
SEED_BLOCKS = 4
#: Anchors whose thresholds are close together, scored at once.
SLICE = 128
_EXACT = float(1 << 53)
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

_BLOCKS = "ids binary, labels binary, slabs binary, norms binary, rows int, dims int"
_ARROW_BLOCKS = pa.schema(
    [(n, pa.binary()) for n in ("ids", "labels", "slabs", "norms")] + [("rows", pa.int32()), ("dims", pa.int32())]
)
_FOUND = "query long, slot int, id long, score long"


@dataclass
class Rows:
    """Some rows of the index, or some anchors: components in index order, norms over slab s and all that follow."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray

    def take(self, which: np.ndarray) -> Rows:
        return Rows(self.ids[which], self.labels[which], self.vectors[which], self.norms[which])


@dataclass
class Wanted:
    """Windows of anchors: ``low`` to ``high`` by anchor and slot, each to be filled with ``k`` rows of the same label or others."""

    low: np.ndarray
    high: np.ndarray
    open: np.ndarray
    k: int
    same: bool


def usable(rows: DataFrame) -> DataFrame:
    """``id, label, vector`` of the rows that take part."""
    used = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "vector")
    return used.where("id is not null and label is not null and vector is not null")


def dimension_order(rows: DataFrame) -> list[int]:
    """Components by their energy, the largest first: a number for each component of a vector, not for each row."""
    energy = rows.select(F.posexplode("vector").alias("dim", "x")).groupBy("dim").agg(F.sum(F.col("x") * F.col("x")).alias("energy"))
    return [row.dim for row in energy.orderBy(F.desc("energy"), "dim").collect()]


def _arranged(lists: pa.Array, order: np.ndarray) -> np.ndarray:
    """Vectors as a matrix with its columns in index order, padded to whole slabs."""
    sizes = np.diff(np.asarray(lists.offsets, np.int64))
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = np.zeros((len(sizes), max(1, len(order))))
    matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = flat
    out = np.zeros((len(sizes), -(-matrix.shape[1] // SLAB) * SLAB))
    out[:, : len(order)] = matrix[:, order]
    return out


def _suffix_norms(matrix: np.ndarray) -> np.ndarray:
    """Norm over slab s and all that follow, by row and s; the last is 0."""
    slabs = matrix.shape[1] // SLAB
    squares = (matrix * matrix).reshape(len(matrix), slabs, SLAB).sum(2)
    norms = np.zeros((len(matrix), slabs + 1))
    norms[:, :-1] = np.sqrt(squares[:, ::-1].cumsum(1)[:, ::-1])
    return norms


def build_index(rows: DataFrame, order: list[int]) -> DataFrame:
    """Blocks of at most :data:`BLOCK_ROWS` rows with posting runs by slab; made in one pass without a shuffle."""
    by = np.array(order, np.int64)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                matrix = _arranged(part.column(2), by)
                slabs = matrix.reshape(len(matrix), -1, SLAB).transpose(1, 0, 2)
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "ids": part.column(0).to_numpy().tobytes(),
                            "labels": part.column(1).to_numpy().tobytes(),
                            "slabs": np.ascontiguousarray(slabs).tobytes(),
                            "norms": _suffix_norms(matrix).tobytes(),
                            "rows": len(matrix),
                            "dims": matrix.shape[1],
                        }
                    ],
                    schema=_ARROW_BLOCKS,
                )

    return rows.select("id", "label", "vector").mapInArrow(task, _BLOCKS)


def _opened(block: dict) -> Rows:
    rows, dims = block["rows"], block["dims"]
    slabs = np.frombuffer(block["slabs"]).reshape(dims // SLAB, rows, SLAB)
    return Rows(
        np.frombuffer(block["ids"], np.int64),
        np.frombuffer(block["labels"], np.int64),
        slabs.transpose(1, 0, 2).reshape(rows, dims),
        np.frombuffer(block["norms"]).reshape(rows, dims // SLAB + 1),
    )


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows of whole numbers, exact; in doubles while they fit."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1]) < _EXACT:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = (whole(a) * whole(b)).sum(1)
    return np.array([min(max(int(x), _LEAST), _MOST) for x in exact], np.int64)


def threshold_join(asked: Rows, block: Rows, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs (place in ``asked``, place in ``block``, score) whose score is at least ``least`` of the anchor."""
    size = asked.norms[:, 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        reach = np.where(size > 0, least / size, np.where(least > 0, np.inf, -np.inf)).min(initial=np.inf)
    slabs = block.vectors.shape[1] // SLAB
    # A row's slabs from the first on that the bound covers are not indexed.
    indexed = (block.norms[:, :-1] * (1 + 1e-9) >= reach).sum(1) if reach > 0 else np.full(len(block.ids), slabs)
    rows = np.argsort(-indexed, kind="stable")
    rows = rows[: np.count_nonzero(indexed)]
    partial = np.zeros((len(asked.ids), len(rows)))
    margin = 1e-9 * size[:, None]

    def alive(at: slice, rest: np.ndarray) -> np.ndarray:
        """Pairs that can still reach their threshold; ``rest``: the first slab not yet counted, by row."""
        some = rows[at]
        bound = asked.norms[:, rest] * block.norms[some, rest] + margin * block.norms[some, 0]
        return partial[:, at] + bound >= least[:, None]

    for s in range(int(indexed.max(initial=0))):
        n = np.searchsorted(-indexed[rows], -s, "left")
        at = slice(s * SLAB, (s + 1) * SLAB)
        partial[:, :n] += asked.vectors[:, at] @ block.vectors[rows[:n], at].T
        if s % 2 and s + 1 < slabs:
            kept = np.ones(len(rows), bool)
            kept[:n] = alive(slice(0, n), np.full(n, s + 1)).any(0)
            if kept.mean() < 0.9:
                rows, partial = rows[kept], partial[:, kept]
    left, right = np.nonzero(alive(slice(0, len(rows)), indexed[rows]))
    right = rows[right]
    found = [np.zeros(0, np.int64)]
    for start in range(0, len(left), 1 << 16):
        some = slice(start, start + (1 << 16))
        found.append(_scores(asked.vectors[left[some]], block.vectors[right[some]]))
    scores = np.concatenate(found)
    enough = scores >= least[left]
    return left[enough], right[enough], scores[enough]


def _firsts(query: np.ndarray, slot: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best rows of each window."""
    # Highest first without negating: the lowest long has no opposite.
    order = np.lexsort((ids, ~scores, slot, query))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(query[order]) != 0) | (np.diff(slot[order]) != 0)
    place = np.arange(len(order))
    return order[place - np.maximum.accumulate(np.where(new, place, 0)) < k]


def fill_windows(blocks: Iterator[Rows], asked: Rows, wanted: Wanted) -> tuple[np.ndarray, ...]:
    """``query place, slot, id, score`` of the best rows of ``blocks`` in each open window."""
    best = tuple(np.zeros(0, np.int64) for _ in range(4))
    lowest = np.where(wanted.open, wanted.low, _MOST).min(1)
    least = np.where(lowest == _LEAST, -np.inf, lowest.astype(np.float64))
    some = np.flatnonzero(wanted.open.any(1))
    with np.errstate(divide="ignore", invalid="ignore"):
        close = np.argsort(np.nan_to_num(least[some] / asked.norms[some, 0], nan=0.0), kind="stable")
    slices = [some[close[i : i + SLICE]] for i in range(0, len(some), SLICE)]
    for block in blocks:
        parts = [best]
        for members in slices:
            mine = asked.take(members)
            left, right, scores = threshold_join(mine, block, least[members])
            fits = (mine.labels[left] == block.labels[right]) == wanted.same
            fits &= mine.ids[left] != block.ids[right]
            left, ids, scores = members[left[fits]], block.ids[right[fits]], scores[fits]
            for slot in range(wanted.low.shape[1]):
                inside = wanted.open[left, slot] & (scores >= wanted.low[left, slot]) & (scores <= wanted.high[left, slot])
                q, i, s = left[inside], ids[inside], scores[inside]
                top = _firsts(q, np.zeros_like(q), i, s, wanted.k)
                parts.append((q[top], np.full(len(top), slot), i[top], s[top]))
        best = tuple(np.concatenate(column) for column in zip(*parts))
        top = _firsts(*best, wanted.k)
        best = tuple(column[top] for column in best)
    return best


def _round(spark: SparkSession, blocks: DataFrame, asked: Rows, wanted: Wanted) -> DataFrame:
    """One pass over the index: ``query, slot, id, score`` of the open windows' best rows."""
    sent = spark.sparkContext.broadcast((asked, wanted))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, windows = sent.value
        rows = (_opened(row) for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist())
        query, slot, ids, scores = fill_windows(rows, mine, windows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(mine.ids[query]), pa.array(slot.astype(np.int32)), pa.array(ids), pa.array(scores)],
            names=["query", "slot", "id", "score"],
        )

    order = Window.partitionBy("query", "slot").orderBy(F.desc("score"), "id")
    found = blocks.mapInArrow(task, _FOUND).withColumn("place", F.row_number().over(order)).where(F.col("place") <= wanted.k)
    found = stored(found, "filled_windows")
    sent.destroy()
    return found


def _seeded(seed: Rows, asked: Rows, wanted: Wanted) -> tuple[np.ndarray, np.ndarray]:
    """First and second threshold of each window: its best and its k-th score in the seed, its own low end without."""
    query, slot, _, scores = fill_windows(iter([seed]), asked, wanted)
    first, second = wanted.low.copy(), wanted.low.copy()
    new = np.ones(len(query), bool)
    new[1:] = (np.diff(query) != 0) | (np.diff(slot) != 0)
    place = np.arange(len(query))
    rank = place - np.maximum.accumulate(np.where(new, place, 0))
    first[query[new], slot[new]] = scores[new]
    full = rank == wanted.k - 1
    second[query[full], slot[full]] = scores[full]
    return first, second


def _filled(spark: SparkSession, blocks: DataFrame, seed: Rows, asked: Rows, wanted: Wanted) -> list[DataFrame]:
    """The rounds over falling thresholds; a window's rows are all in the round that fills it."""
    rounds = []
    first, second = _seeded(seed, asked, wanted)
    place = {int(i): n for n, i in enumerate(asked.ids)}
    still = wanted.open.copy()
    for low in (first, second, wanted.low):
        if not still.any():
            break
        found = _round(spark, blocks, asked, Wanted(low, wanted.high, still, wanted.k, wanted.same))
        last = still & (low == wanted.low)
        full = np.zeros_like(still)
        # At most one row for each window of a batch.
        for row in found.groupBy("query", "slot").count().where(F.col("count") >= wanted.k).collect():
            full[place[row.query], row.slot] = True
        done = still & (full | last)
        rounds.append((found, done))
        still &= ~done
    return [_of_windows(spark, found, asked, done) for found, done in rounds]


def _of_windows(spark: SparkSession, found: DataFrame, asked: Rows, done: np.ndarray) -> DataFrame:
    """Rows of the windows that were done in this round."""
    if done.all():
        return found
    query, slot = np.nonzero(done)
    windows = pa.table({"query": pa.array(asked.ids[query]), "slot": pa.array(slot.astype(np.int32))})
    return found.join(spark.createDataFrame(windows), ["query", "slot"], "left_semi")


def _below(scores: np.ndarray, open_: np.ndarray, low: int, high: int) -> Wanted:
    """Windows of the negatives: low * positive <= 100 * score <= high * positive."""
    lows, highs, used = np.zeros_like(scores), np.zeros_like(scores), open_.copy()
    for at in zip(*np.nonzero(open_)):
        positive = int(scores[at])
        least, most = -(-low * positive // 100), high * positive // 100
        used[at] = least <= most
        lows[at], highs[at] = max(min(least, _MOST), _LEAST), max(min(most, _MOST), _LEAST)
    return Wanted(lows, highs, used, 0, False)


def _batches(anchors: DataFrame, width: int) -> Iterator[DataFrame]:
    """Anchors by id, at most about :data:`BATCH_BYTES` each time."""
    once = anchors.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.*")
    once = stored(once.withColumn("deal", F.xxhash64("id")), "anchors")
    n = once.count()
    passes = max(1, -(-n * (8 * width + 64) // BATCH_BYTES))
    for i in range(passes):
        yield once.where(F.pmod("deal", F.lit(passes)) == i)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``id, label, vector`` rows.

    ``vector`` holds whole numbers as doubles, see ``topk.scaled``. ``low`` and ``high`` are percentages of the positive's
    score between which a negative's lies.
    """
    spark = rows.sparkSession
    rows = stored(usable(rows), "labelled_vectors")
    order = dimension_order(rows)
    blocks = stored(build_index(rows, order), "posting_blocks")
    parts = [_opened(b) for b in blocks.limit(SEED_BLOCKS).toArrow().to_pylist()]
    path = scratch_path(spark, "hard_negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(path)
    if not parts:
        return spark.read.schema(schema).parquet(path)
    seed = Rows(*(np.concatenate([getattr(p, k) for p in parts]) for k in ("ids", "labels", "vectors", "norms")))
    by = np.array(order, np.int64)
    for batch in _batches(usable(anchors), len(order)):
        table = batch.select("id", "label", "vector").toArrow().combine_chunks()
        if not table.num_rows:
            continue
        vectors = _arranged(table.column(2).combine_chunks(), by)
        asked = Rows(table.column(0).to_numpy(), table.column(1).to_numpy(), vectors, _suffix_norms(vectors))
        shape = (len(asked.ids), 1)
        near = Wanted(np.full(shape, _LEAST), np.full(shape, _MOST), np.ones(shape, bool), positives, True)
        found = stored(_union(_filled(spark, blocks, seed, asked, near)), "positives")
        # At most ``positives`` rows for each anchor of the batch.
        known = found.select("query", "place", "score").toArrow()
        place = {int(i): n for n, i in enumerate(asked.ids)}
        scores, open_ = np.zeros((len(asked.ids), positives), np.int64), np.zeros((len(asked.ids), positives), bool)
        of, slot = [place[i] for i in known.column(0).to_pylist()], known.column(1).to_numpy() - 1
        scores[of, slot], open_[of, slot] = known.column(2).to_numpy(), True
        wanted = _below(scores, open_, low, high)
        wanted.k = negatives
        if not wanted.open.any():
            continue
        below = _union(_filled(spark, blocks, seed, asked, wanted))
        below = below.select("query", (F.col("slot") + 1).alias("slot"), "place", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        above = found.select("query", F.col("place").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        mined = below.join(above, ["query", "slot"]).withColumnsRenamed({"query": "anchor_id", "place": "rank"})
        mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole


def relabelled(vec_id: Column, label: Column) -> Column:
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    whole = rows.select(
        F.col("vec_id").alias("id"), relabelled(F.col("vec_id"), F.col("label")).alias("label"), scaled(F.col("embedding")).alias("vector")
    )
    return mine(whole, whole.where(F.col("id") % 50 == 0))


#: The same by comparing every anchor with every row.
OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same
), n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND p.place <= 5
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3
"""
