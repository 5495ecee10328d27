"""Document fingerprints by locally consistent parsing.

A text is a sequence of symbols, at first its code points. Runs of one symbol become one symbol. Deterministic coin
tossing then gives every symbol a small label: the lowest bit in which it differs from its left neighbour, and the
value of that bit; repeated on the labels until few are left, adjacent labels staying different. Local maxima of the
labels begin phrases. A phrase's name is a hash of the symbols in it, and the names are the next level's symbols. Whether
a place begins a phrase depends on a few symbols around it only, so equal substrings are cut and named alike
inside, whatever stands before them.

The fingerprint keeps, for each level of :data:`LEVELS`, a one-permutation minimum sketch of its phrase names:
``SLOTS`` slots with the last 8 bits of their minimum, written as hexadecimal digits, ``--`` for an empty slot. Likeness is the mean over the
levels that either document has of the share of equal slots among those filled in either, so it estimates
how many phrases are shared.

Defined results: a null text is the empty text, whose fingerprint has empty slots only; two empty fingerprints have
likeness 1, an empty and another one 0. Equal texts have equal fingerprints. :func:`with_next_document` orders by
descending ``doc_id`` (nulls last; rows that share an id by descending text hash) and closes the ring; one row alone
is its own next document. It reads ``doc_id`` and ``text`` only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfold.llm.arrays import Spans, mixed
from termfold.session import stored

LEVELS = (2, 3, 4)
SLOTS = 32
_EMPTY = 1 << 8
_NONE = 1 << 62
#: Code points that are parsed together.
PARSED_TOGETHER = 1 << 18


def _label_table() -> np.ndarray:
    """Next label from a label (below 128) and its left neighbour's."""
    own, left = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    differ = own ^ left
    place = np.zeros_like(differ)
    for bit in reversed(range(7)):
        place[(differ >> bit) & 1 == 1] = bit
    return (2 * place + ((own >> place) & 1)).astype(np.uint8).reshape(-1)


_NEXT = _label_table()
#: Place of the lowest set bit, by the remainder of the bit modulo 67 (all powers of two below 2**64 differ there).
_PLACE = np.zeros(67, np.uint8)
_PLACE[[(1 << i) % 67 for i in range(64)]] = np.arange(64)


def _labels(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Small labels of symbols that differ from their left neighbours; ``first`` marks where a text begins."""
    left = np.empty_like(symbols)
    left[1:] = symbols[:-1]
    left[first] = ~symbols[first]
    differ = symbols ^ left
    place = _PLACE[(differ & (~differ + np.uint64(1))) % np.uint64(67)]
    labels = (2 * place + ((symbols >> place.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)).astype(np.uint8)
    for _ in range(3):
        left_labels = np.empty_like(labels)
        left_labels[1:] = labels[:-1]
        left_labels[first] = labels[first] ^ 1
        labels = _NEXT[(labels.astype(np.int32) << 7) | left_labels]
    return labels


def _without_runs(symbols: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every run of one symbol in one text as a symbol named by symbol and length; single ones stay."""
    new = np.ones(len(symbols), bool)
    new[1:] = (symbols[1:] != symbols[:-1]) | (texts[1:] != texts[:-1])
    if new.all():
        return symbols, texts
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(symbols)))
    names = symbols[starts]
    long = lengths > 1
    names[long] = mixed(names[long] + lengths[long].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return names, texts[starts]


def _phrases(symbols: np.ndarray, texts: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of each text, and the text of each."""
    symbols, texts = _without_runs(symbols, texts)
    first = np.ones(len(symbols), bool)
    first[1:] = texts[1:] != texts[:-1]
    begins = np.flatnonzero(first)
    labels = _labels(symbols, begins)
    top = np.zeros(len(labels), bool)
    top[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    # A text's last symbol never begins a phrase, the second does not either: phrases have two symbols or more.
    last = np.append(begins[1:], len(symbols)) - 1
    top[last] = False
    top[np.minimum(begins + 1, len(symbols) - 1)] = False
    starts = np.flatnonzero(top | first)
    ends = np.append(starts[1:], len(symbols))
    names = Spans(symbols)(starts, ends)
    return mixed(names + np.uint64(level)), texts[starts]


def sketches(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sketch (levels * slots) of each text, from the code points of all and the n + 1 bounds."""
    n = len(offsets) - 1
    out = np.full((n, len(LEVELS) * SLOTS), _NONE, np.int64)
    if not len(points):
        return np.full_like(out, _EMPTY)
    symbols = mixed(points.astype(np.uint64) + np.uint64(1))
    texts = np.repeat(np.arange(n), np.diff(offsets))
    for level in range(1, max(LEVELS) + 1):
        symbols, texts = _phrases(symbols, texts, level)
        if level in LEVELS:
            at = LEVELS.index(level) * SLOTS
            slot = texts * out.shape[1] + at + (symbols & np.uint64(SLOTS - 1)).astype(np.int64)
            np.minimum.at(out.reshape(-1), slot, (symbols >> np.uint64(16)).astype(np.int64))
    return np.where(out == _NONE, _EMPTY, out & (_EMPTY - 1))


def text_sketches(texts: list[str]) -> np.ndarray:
    """Sketches of whole texts, some at a time."""
    parts, held, size = [], [], 0
    for text in texts:
        held.append(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))
        size += len(held[-1])
        if size >= PARSED_TOGETHER:
            parts.append(_sketched(held))
            held, size = [], 0
    if held:
        parts.append(_sketched(held))
    return np.concatenate(parts) if parts else np.zeros((0, len(LEVELS) * SLOTS), np.int64)


def _sketched(points: list[np.ndarray]) -> np.ndarray:
    return sketches(np.concatenate(points), np.cumsum([0, *map(len, points)]))


def written(sketch: np.ndarray) -> str:
    return "".join("--" if x == _EMPTY else f"{x:02x}" for x in sketch.tolist())


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness of the sketches in equal rows."""
    a, b = (x.reshape(len(x), len(LEVELS), SLOTS) for x in (a, b))
    filled = (a != _EMPTY) | (b != _EMPTY)
    equal = ((a == b) & filled).sum(2)
    filled = filled.sum(2)
    levels = (filled > 0).sum(1)
    shares = np.where(filled > 0, equal / np.maximum(filled, 1), 0.0).sum(1)
    return np.where(levels > 0, shares / np.maximum(levels, 1), 1.0)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the first as many code points of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ROWS = f"edge string, part int, text string, {_RESULT}"


def _compared(ids: list, texts: list[str], following: list[str]) -> dict[str, pa.Array]:
    own = text_sketches(texts)
    changed = [edited(a, b) for a, b in zip(texts, following)]
    after = text_sketches(changed)
    # A document's next one is mostly the next row; only others are parsed again.
    chained = [i + 1 < len(texts) and following[i] is texts[i + 1] for i in range(len(texts))]
    nexts = np.concatenate((own[1:], own[:1])) if len(own) else own
    if not all(chained):
        other = [i for i, c in enumerate(chained) if not c]
        nexts[other] = text_sketches([following[i] for i in other])
    return {
        "doc_id": pa.array(ids, pa.int64()),
        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        "edited_sha256": pa.array(
            [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()
        ),
        "fingerprint": pa.array([written(s) for s in own], pa.string()),
        "edited_fingerprint": pa.array([written(s) for s in after], pa.string()),
        "near_edited": pa.array(likeness(own, after), pa.float64()),
        "near_next": pa.array(likeness(own, nexts), pa.float64()),
    }


def _sorted_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows of a sorted partition but its last; its first and last row as edges."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    first = held = None

    def edge(kind: str, row: tuple) -> pa.RecordBatch:
        values = {"edge": kind, "part": part, "text": row[1], "doc_id": row[0]}
        return pa.RecordBatch.from_pylist([values], schema=_ARROW_ROWS)

    for batch in batches:
        ids = batch.column(0).to_pylist()
        texts = [text or "" for text in batch.column(1).to_pylist()]
        if not ids:
            continue
        if first is None:
            first = (ids[0], texts[0])
            yield edge("first", first)
        if held:
            ids, texts = [held[0], *ids], [held[1], *texts]
        held = (ids[-1], texts[-1])
        if len(ids) > 1:
            columns = _compared(ids[:-1], texts[:-1], texts[1:])
            n = len(ids) - 1
            empty = {"edge": pa.nulls(n, pa.string()), "part": pa.nulls(n, pa.int32()), "text": pa.nulls(n, pa.string())}
            columns = empty | columns
            yield pa.RecordBatch.from_arrays([columns[name] for name in _ARROW_ROWS.names], schema=_ARROW_ROWS)
    if held:
        yield edge("last", held)


_ARROW_ROWS = pa.schema(
    [("edge", pa.string()), ("part", pa.int32()), ("text", pa.string()), ("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [(n, pa.float64()) for n in ("near_edited", "near_next")]
)


def _edges_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = _compared(*(batch.column(i).to_pylist() for i in range(3)))
        yield pa.RecordBatch.from_pydict(columns)


def with_next_document(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and the likenesses of both and of the next document.

    Texts are moved once, to be sorted by range of ids. Only the rows at the edges of the sorted ranges meet their
    neighbours in a second step, by the number of the range; the driver sees those numbers, no texts.
    """
    spark = docs.sparkSession
    order = F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", order.alias("_order"))
    ordered = rows.repartitionByRange(F.desc("_order")).sortWithinPartitions(F.desc("_order"))
    done = stored(ordered.select("doc_id", "text").mapInArrow(_sorted_task, _ROWS), "fingerprints")
    inner = done.where("edge is null").drop("edge", "part", "text")
    parts = [row.part for row in done.where("edge = 'first'").select("part").orderBy("part").collect()]
    following = dict(zip(parts, parts[1:] + parts[:1]))
    pairs = spark.createDataFrame(list(following.items()) or [(None, None)], "part int, next_part int")
    last = done.where("edge = 'last'").select("part", "doc_id", "text").join(pairs, "part")
    after = done.where("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    edges = last.join(after, "next_part").select("doc_id", "text", "following")
    return inner.unionByName(edges.mapInArrow(_edges_task, _RESULT))


def op8_fingerprints(spark, sf_dir: str) -> DataFrame:
    return with_next_document(spark.read.parquet(f"{sf_dir}/documents.parquet"))
