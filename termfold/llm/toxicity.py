"""Toxicity by the nearest labelled examples.

Terms are all words of the examples, folded to lower case, with their frequencies in a text. A term's weight is
(1 + log of its count) times its inverse document frequency in all documents, times the square of its relevance
frequency: log2(2 + its rate among toxic examples, less one example, over its rate among clean ones). (Without the last
factor neighbours share a subject, not a tone; see the README for figures of both.) Similarity is the exact cosine over
the examples' terms. Examples with equal vectors are one entry with the votes of both labels.

Entries are held in an inverted index in blocks, with the largest weight of every term in every block. For a text, the
bound of a block is the sum over the text's terms of weight times the block's largest weight. The blocks with the best
bounds are scored first, then all whose bound reaches the k-th similarity found; ties count. Postings of terms that are in
at least ``COMMON`` of the entries are kept as rows of a matrix, whose blocks are multiplied. Votes are weighted by
1 / (distance + ``SOFT``), and the share of toxic votes is calibrated by a logistic curve fitted on leave-one-out votes
of the examples.

Bound of the fit: at most ``EXAMPLES`` labelled rows of each label, those of lowest hash of their id; document
frequencies come from all documents. What the driver holds is bounded by the examples and their terms.

Defined results: null and empty texts, and texts without any term of an example, share the score of the examples without
one, drawn towards the share of all. A label that is null teaches nothing; of several labels of one id the largest counts, of
several texts of one id all are examples. Without both labels the score is the share of the one there is, without labels
it is 0. Equal similarities are taken by entry. :func:`score` keeps other columns and replaces those of its own names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfold.llm.arrays import BYTE_VALUES, Spans, counted, list_column, lower_ascii, mixed, rows_of, slices, with_text_columns, word_bounds
from termfold.llm.langid import held_out
from termfold.session import stored

EXAMPLES = 2048
NEIGHBOURS = 15
BLOCK = 64
SOFT = 0.05
THRESHOLD = 0.7
#: Examples without a term are too few at times: so many of the common share are added to them.
PRIOR_EXAMPLES = 20
#: Blocks of a text that are scored before bounds are compared.
FIRST_BLOCKS = 4
#: Texts scored at once.
TOGETHER = 128
#: Share of the entries from which on a term's postings are kept as a row of a matrix.
COMMON = 0.05
#: Counts that a row of document frequencies carries.
CHUNK = 1 << 14
_TOP = 44
_FINE = 1e12

_VALUES = lower_ascii(BYTE_VALUES)
_NO_LETTER = np.ones(256, bool)
_NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_NONE = np.zeros(0, np.int64)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word."""
    data = data.copy()
    # Capital letters of Latin-1, in UTF-8.
    data[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)] += 0x20
    starts, ends = word_bounds(data, offsets, _NO_LETTER)
    return mixed(Spans(_VALUES[data])(starts, ends)), rows_of(starts, offsets)


def _runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range of each."""
    sizes = ends - starts
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[of], of


class Terms:
    """The examples' terms, sorted by hash."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.first = np.searchsorted(hashes >> np.uint64(_TOP), np.arange((1 << (64 - _TOP)) + 1, dtype=np.uint64))

    def __len__(self) -> int:
        return len(self.hashes)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each term, -1 for others."""
        top = (hashes >> np.uint64(_TOP)).astype(np.int64)
        at, last = self.first[top], self.first[top + 1]
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.flatnonzero(at < last)
        while len(open_):
            hit = self.hashes[at[open_]] == hashes[open_]
            out[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit]
            at[open_] += 1
            open_ = open_[at[open_] < last[open_]]
        return out

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``row, term, count`` of each text, by row and term."""
        if not len(self):
            return _NONE, _NONE, _NONE
        hashes, rows = _words(data, offsets)
        at = self.places(hashes)
        known = at >= 0
        keys, counts = counted(rows[known] * len(self) + at[known])
        return keys // len(self), keys % len(self), counts


@dataclass
class Model:
    """Terms, weights and the index of examples: as large as the examples' texts at most."""

    terms: Terms
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    prior: float = 0.0
    curve: tuple[float, float] = (1.0, 0.0)
    clean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    ids: np.ndarray = field(default_factory=lambda: _NONE)
    #: By term: its blocks (``block``, the largest weight ``most``); by these: its postings.
    term_start: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    block: np.ndarray = field(default_factory=lambda: _NONE)
    most: np.ndarray = field(default_factory=lambda: np.zeros(0))
    block_start: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    entry: np.ndarray = field(default_factory=lambda: _NONE)
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    _common: tuple | None = field(default=None, repr=False)

    def vectors(self, row: np.ndarray, term: np.ndarray, count: np.ndarray, rows: int) -> np.ndarray:
        """Weights of length 1 for each row."""
        weights = (1 + np.log(count)) * self.weights[term]
        norms = np.sqrt(np.bincount(row, weights**2, rows))
        return weights / np.where(norms > 0, norms, 1)[row]

    def nearest(self, row: np.ndarray, term: np.ndarray, count: np.ndarray, rows: int, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Entries of the ``k`` largest cosines of each row and those cosines, best first; cosine 0 where there are fewer."""
        entries, cosines = np.zeros((rows, k), np.int64), np.zeros((rows, k))
        if not len(self.ids):
            return entries, cosines
        weights = self.vectors(row, term, count, rows)
        bounds_of = np.searchsorted(row, np.arange(0, rows + TOGETHER, TOGETHER))
        for i, low in enumerate(range(0, rows, TOGETHER)):
            part = slice(bounds_of[i], bounds_of[i + 1])
            n = min(TOGETHER, rows - low)
            some, values = self._nearest(row[part] - low, term[part], weights[part], n, k)
            entries[low : low + n, : some.shape[1]], cosines[low : low + n, : some.shape[1]] = some, values
        return entries, cosines

    def rows_of_common(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of each term in the matrix (-1: none), the matrix by entry and its largest values by block; made once in a worker."""
        if self._common is None:
            size, blocks = len(self.ids), -(-len(self.ids) // BLOCK)
            postings = self.block_start[self.term_start[1:]] - self.block_start[self.term_start[:-1]]
            common = np.flatnonzero(postings >= max(2, COMMON * size))
            place = np.full(len(self.terms), -1, np.int64)
            place[common] = np.arange(len(common))
            matrix = np.zeros((len(common), blocks * BLOCK))
            at, of = _runs(self.block_start[self.term_start[common]], self.block_start[self.term_start[common + 1]])
            matrix[of, self.entry[at]] = self.value[at]
            self._common = place, matrix, matrix.reshape(len(common), blocks, BLOCK).max(2)
        return self._common

    def _nearest(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        size, blocks = len(self.ids), -(-len(self.ids) // BLOCK)
        place, matrix, most = self.rows_of_common()
        common = place[term] >= 0
        dense = np.zeros((rows, len(matrix)))
        dense[row[common], place[term[common]]] = weight[common]
        row, term, weight = row[~common], term[~common], weight[~common]
        at, of = _runs(self.term_start[term], self.term_start[term + 1])
        row, weight = row[of], weight[of]
        cell = row * blocks + self.block[at]
        bounds = np.bincount(cell, weight * self.most[at], rows * blocks).reshape(rows, blocks) + dense @ most
        scores = np.zeros((rows, blocks * BLOCK))

        def opened(which: np.ndarray) -> None:
            for block in np.flatnonzero(which.any(0)):
                asked = np.flatnonzero(which[:, block])
                part = slice(block * BLOCK, (block + 1) * BLOCK)
                scores[asked, part] += dense[asked] @ matrix[:, part]
            some = which.ravel()[cell]
            posting, run = _runs(self.block_start[at[some]], self.block_start[at[some] + 1])
            cells = row[some][run] * scores.shape[1] + self.entry[posting]
            scores.ravel()[:] += np.bincount(cells, weight[some][run] * self.value[posting], scores.size)

        def ordered() -> np.ndarray:
            """Cosines as whole numbers with the entry behind, so that no two are equal."""
            fine = np.round(scores[:, :size] * _FINE).astype(np.int64)
            return fine * size + (size - 1 - np.arange(size))

        k = min(k, size)
        first = np.ones((rows, blocks), bool)
        if blocks > FIRST_BLOCKS:
            first[:] = False
            best = np.argpartition(-bounds, FIRST_BLOCKS, axis=1)[:, :FIRST_BLOCKS]
            np.put_along_axis(first, best, True, 1)
        first &= bounds > 0
        opened(first)
        least = np.partition(scores[:, :size], size - k, axis=1)[:, size - k]
        more = ~first & (bounds > 0) & (bounds >= least[:, None] - 1e-9)
        if more.any():
            opened(more)
        keys = ordered()
        top = np.argpartition(keys, size - k, axis=1)[:, size - k :]
        found = np.take_along_axis(keys, top, 1)
        order = np.argsort(-found, axis=1)
        found = np.take_along_axis(found, order, 1)
        return size - 1 - found % size, found // size / _FINE

    def shares(self, entries: np.ndarray, cosines: np.ndarray, without: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Share of toxic votes of each row; ``without``: an entry of each row and the votes it gives up."""
        clean, toxic = (x[entries] if len(x) else np.zeros(entries.shape) for x in (self.clean, self.toxic))
        if without:
            own = entries == without[0][:, None]
            clean, toxic = clean - own * without[1][:, None], toxic - own * without[2][:, None]
        weight = np.where(cosines > 0, 1 / (1 - np.minimum(cosines, 1) + SOFT), 0)
        votes = (weight * (clean + toxic)).sum(1)
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(votes > 1e-12, (weight * toxic).sum(1) / votes, self.prior)

    def calibrated(self, shares: np.ndarray) -> np.ndarray:
        slope, shift = self.curve
        return 1 / (1 + np.exp(-(slope * _log_odds(shares) + shift)))


def _log_odds(share):
    share = np.clip(share, 1e-3, 1 - 1e-3)
    return np.log(share / (1 - share))


def _examples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    once = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("_toxic"))
    ranked = once.withColumn("_rank", F.xxhash64("doc_id"))
    chosen = [ranked.where(F.col("_toxic") == label).orderBy("_rank", "doc_id").limit(EXAMPLES) for label in (False, True)]
    sample = chosen[0].unionByName(chosen[1]).select(F.col("doc_id").alias("_id"), "_toxic")
    # At most 2 * EXAMPLES rows.
    return docs.join(F.broadcast(sample), docs["doc_id"] == F.col("_id")).select("_id", "_toxic", docs["text"].alias("text"))


def _term_counts(examples: DataFrame) -> pa.Table:
    """``id, toxic, terms, counts`` of each example."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in slices(batch.column(2)):
                hashes, rows = _words(data, offsets)
                distinct, which = np.unique(hashes, return_inverse=True)
                keys, counts = counted(rows * max(1, len(distinct)) + which)
                ends = np.searchsorted(keys, np.arange(end - start + 1) * max(1, len(distinct)))
                terms = distinct[keys % max(1, len(distinct))].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[start:end], batch.column(1)[start:end], list_column(terms, ends), list_column(counts, ends)],
                    names=["id", "toxic", "terms", "counts"],
                )

    return examples.mapInArrow(task, "id long, toxic boolean, terms array<long>, counts array<long>").toArrow()


def _document_frequencies(docs: DataFrame, terms: Terms) -> tuple[np.ndarray, int]:
    """In how many documents each term is, and the number of documents."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        counts, documents = np.zeros(len(known), np.int64), 0
        for batch in batches:
            documents += batch.num_rows
            for _, _, data, offsets in slices(batch.column(0)):
                counts += np.bincount(known.counts(data, offsets)[1], minlength=len(known))
        parts = [counts[i : i + CHUNK].tobytes() for i in range(0, len(counts), CHUNK)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *range(len(parts))], pa.int64()), pa.array([np.int64(documents).tobytes(), *parts], pa.binary())], names=["chunk", "counts"]
        )

    def summed(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())
        return pa.table({"chunk": table.column("chunk")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "chunk long, counts binary"
    # A row for each task and chunk; the chunks together are as long as the terms.
    parts = docs.select("text").mapInArrow(task, schema).groupBy("chunk").applyInArrow(summed, schema).collect()
    by_chunk = {row.chunk: np.frombuffer(row.counts, np.int64) for row in parts}
    documents = int(by_chunk.pop(-1, [0])[0])
    sent.unpersist()
    return np.concatenate([_NONE, *(by_chunk[i] for i in sorted(by_chunk))]), documents


def fit(docs: DataFrame, labels: DataFrame, corpus: DataFrame | None = None) -> Model:
    """A model from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``); ``corpus`` (default ``docs``) is
    what document frequencies are counted in."""
    corpus = docs if corpus is None else corpus
    examples = stored(_examples(docs, labels), "toxicity_examples")
    table = _term_counts(examples)
    toxic = np.array(table.column("toxic").to_pylist(), bool)
    n = {False: int((~toxic).sum()), True: int(toxic.sum())}
    if not n[False] or not n[True]:
        return Model(Terms(np.zeros(0, np.uint64)), prior=float(n[True] > 0), curve=(0.0, 20.0 if n[True] else -700.0))
    order = np.argsort(table.column("id").to_numpy(), kind="stable")
    kept = [(table.column("id")[i].as_py(), bool(toxic[i]), *(np.array(table.column(k)[i].as_py(), np.int64) for k in ("terms", "counts"))) for i in order.tolist()]
    model = Model(Terms(np.unique(np.concatenate([_NONE, *(x[2] for x in kept)]).view(np.uint64))))
    df, documents = _document_frequencies(corpus, model.terms)
    kept = [(i, label, model.terms.places(hashes.view(np.uint64)), counts) for i, label, hashes, counts in kept]
    in_label = {label: np.bincount(np.concatenate([_NONE, *(x[2] for x in kept if x[1] == label)]), minlength=len(df)) for label in n}
    rate = (np.maximum(in_label[True] - 1, 0) / n[True]) / (np.maximum(in_label[False], 1) / n[False])
    model.weights = np.log((1 + documents) / (1 + df)) * np.log2(2 + rate) ** 2
    # Each label's votes weigh as much as its share of all labels, also where the sample takes more of one.
    true = labels.where("toxic is not null").agg(F.avg((F.col("toxic") > 0).cast("double")).alias("share")).first().share
    weight = {False: (1 - true) / n[False], True: true / n[True]}
    model.prior = float(true)
    entries: dict[bytes, list] = {}
    for i, label, terms, counts in kept:
        entry = entries.setdefault(_key(terms, counts), [i, 0.0, 0.0, terms, counts])
        entry[1 + label] += weight[label]
    empty = entries.pop(_key(_NONE, _NONE), None)
    if empty:
        pull = PRIOR_EXAMPLES / (n[False] + n[True])
        model.prior = (empty[2] + pull * float(true)) / (empty[1] + empty[2] + pull)
    place = _index(model, entries)
    _calibrate(model, kept, place, weight)
    return model


def _key(terms: np.ndarray, counts: np.ndarray) -> bytes:
    order = np.argsort(terms, kind="stable")
    return terms[order].tobytes() + counts[order].tobytes()


def _index(model: Model, entries: dict[bytes, list]) -> dict[bytes, int]:
    """Fill the model's index; the place of each entry."""
    def heaviest(item: tuple) -> tuple:
        _, _, _, terms, counts = item[1]
        weights = (1 + np.log(counts)) * model.weights[terms]
        return terms[np.lexsort((terms, -weights))[:3]].tolist(), item[0]

    # Entries whose heaviest terms agree lie together, so that blocks have tight bounds.
    ranked = sorted(entries.items(), key=heaviest)
    model.ids = np.array([x[0] for _, x in ranked], np.int64)
    model.clean, model.toxic = (np.array([x[i] for _, x in ranked], float) for i in (1, 2))
    sizes = [len(x[3]) for _, x in ranked]
    entry = np.repeat(np.arange(len(ranked)), sizes)
    term, count = (np.concatenate([_NONE, *(x[i] for _, x in ranked)]) for i in (3, 4))
    value = model.vectors(entry, term, count, len(ranked))
    order = np.lexsort((entry, term))
    entry, term, value = entry[order], term[order], value[order]
    block = entry // BLOCK
    new = np.ones(len(entry), bool)
    new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
    starts = np.flatnonzero(new)
    model.entry, model.value = entry, value
    model.block, model.block_start = block[starts], np.append(starts, len(entry))
    model.most = np.maximum.reduceat(value, starts) if len(starts) else np.zeros(0)
    model.term_start = np.searchsorted(term[starts], np.arange(len(model.terms) + 1))
    return {key: i for i, (key, _) in enumerate(ranked)}


def _calibrate(model: Model, kept: list, place: dict[bytes, int], weight: dict[bool, float]) -> None:
    """A logistic curve of the votes that examples get from all others, by Newton's method."""
    y = np.array([label for _, label, _, _ in kept], float)
    w = np.where(y > 0, weight[True], weight[False])
    own = np.array([place.get(_key(terms, counts), -1) for _, _, terms, counts in kept])
    row = np.repeat(np.arange(len(kept)), [len(terms) for _, _, terms, _ in kept])
    term, count = (np.concatenate([_NONE, *(x[i] for x in kept)]) for i in (2, 3))
    entries, cosines = model.nearest(row, term, count, len(kept))
    shares = model.shares(entries, cosines, (own, w * (y == 0), w * (y > 0)))
    x = _log_odds(shares)
    design = np.stack((x, np.ones_like(x)), 1)
    curve, pull = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    ridge = np.eye(2) * 1e-3
    w = w / w.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ curve))
        gradient = design.T @ (w * (p - y)) + ridge @ (curve - pull)
        step = np.linalg.solve(design.T @ (design * (w * p * (1 - p))[:, None]) + ridge, gradient)
        curve = curve - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    model.curve = (float(max(curve[0], 1e-3)), float(curve[1]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``evidence``, the ids of the nearest examples, of each whole ``text``."""
    # Without the matrix, which each worker makes for itself.
    sent = docs.sparkSession.sparkContext.broadcast(replace(model, _common=None))

    def added(texts: pa.Array) -> list[pa.Array]:
        known = sent.value
        scores, ids, sizes = [np.zeros(0)], [_NONE], [_NONE]
        for start, end, data, offsets in slices(texts):
            row, term, count = known.terms.counts(data, offsets)
            entries, cosines = known.nearest(row, term, count, end - start)
            shares = known.shares(entries, cosines)
            some = cosines > 0
            scores.append(np.where(some.any(1) | (len(known.ids) == 0), known.calibrated(shares), known.prior))
            ids.append(known.ids[entries[some]] if len(known.ids) else _NONE)
            sizes.append(some.sum(1))
        ends = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        return [pa.array(np.concatenate(scores)), list_column(np.concatenate(ids), ends)]

    return with_text_columns(docs, added, "score double, evidence array<long>")


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    learn = ~held_out(F.col("doc_id"))
    model = fit(docs.where(learn), labels.where(learn), corpus=docs)
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "evidence",
    )
