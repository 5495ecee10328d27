"""Line deduplication by a deletion-neighbourhood join.

Lines are sequences of words (runs between ASCII white space). A line goes if an earlier line of the corpus has the same
words, or, for lines of at least ``near_words`` words, is one word away: one word changed, added or removed. Earlier
means smaller ``doc_id``, then smaller line number. Whether that earlier line goes itself does not matter, so the result
does not depend on any order of work. Lines without words stay.

A line's neighbourhood are its variants with one word deleted: with the gap marked, they are equal for
lines that differ in that word; closed up, they equal the whole of a line that lacks the word. Variants are joined as
64-bit keys; the earliest line of a key is a candidate for every other, and the edit distance of each such pair is
verified on the words. Per key only the earliest line is taken, so a key that very many lines share makes no pairs.

Long lines have many variants, so only lines that can have a neighbour emit them: of two lines one word apart, the first
h words or the last h words are equal, for any h up to half of the shorter. That is asked first, of distinct lines, with
h the largest power of two up to the half (a line whose length is a power of two asks for its shorter neighbours too).

Defined results: a null text stays null. A null ``doc_id`` counts as the smallest long. Rows with equal ``doc_id`` and
text are one document and get the same result; lines at one place of rows that share only the id do not remove each
other if their words are equal. Documents keep their place even if no line is left (their text is then empty).
Columns other than ``text`` are kept; ``n_lines`` and ``n_removed`` are added or replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from termfold.llm.arrays import BYTE_VALUES, Spans, mixed, powers, rows_of, signed, slices, word_bounds
from termfold.llm.filters import split_by
from termfold.session import stored

NEAR_WORDS = 8
_LENGTH = np.uint64(0x9E3779B97F4A7C15)
_GAP = np.uint64(0xC2B2AE3D27D4EB4F)
_BACK = np.uint64(pow(int(powers(2)[1]), -1, 1 << 64))
WILD, BASE, LONGER = 0, 1, 2

_LINES = "doc long, row long, line int, words int, h long, k0 long, k1 long, k2 long, k3 long"


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word."""
    starts, ends = word_bounds(data, offsets)
    return mixed(Spans(BYTE_VALUES[data])(starts, ends)), starts


def line_keys(data: np.ndarray, offsets: np.ndarray, near_words: int) -> dict[str, np.ndarray]:
    """Lines with words: text, line number, number of words, hash, and the keys of their ends."""
    breaks = np.flatnonzero(data == 10) + 1
    bounds = np.union1d(offsets[:-1], breaks)
    words, at = _words(data, offsets)
    of = rows_of(at, bounds)
    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.zeros(0, np.int64)
    end = np.append(first[1:], len(of))
    start_byte = bounds[of[first]]
    text = rows_of(start_byte, offsets)
    line = np.searchsorted(breaks, start_byte, "right") - np.searchsorted(breaks, offsets[:-1], "right")[text]
    n = end - first
    spans = Spans(words)
    out = {"text": text, "line": line, "words": n, "h": mixed(spans(first, end) + n.astype(np.uint64) * _LENGTH)}
    near = n >= near_words
    half = np.where(n > 1, 1 << (np.frexp(np.maximum(n, 1))[1] - 2).clip(0), 1)
    power = near & (n == 2 * half) & (n > near_words)
    for name, size, asked, tail in (("k0", half, near, 0), ("k1", half, near, 1), ("k2", half // 2, power, 0), ("k3", half // 2, power, 1)):
        size = np.minimum(np.maximum(size, 1), n)
        span = spans(end - size, end) if tail else spans(first, first + size)
        out[name] = mixed(span + (2 * size + tail).astype(np.uint64) * _GAP)
        out[name + "?"] = ~asked
    return out


def lines_of(docs: DataFrame, near_words: int = NEAR_WORDS) -> DataFrame:
    """A row for each line with words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for start, _, data, offsets in slices(batch.column(2)):
                found = line_keys(data, offsets, near_words)
                of = found["text"] + start
                keys = [pa.array(signed(found[k]), mask=found[k + "?"]) for k in ("k0", "k1", "k2", "k3")]
                counts = [pa.array(found[k].astype(np.int32)) for k in ("line", "words")]
                columns = [pa.array(ids[of]), pa.array(rows[of]), *counts, pa.array(signed(found["h"])), *keys]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _LINES.split(", ")])

    return docs.select(_doc(), _row(), "text").where("text is not null").mapInArrow(task, _LINES)


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc")


def _row() -> Column:
    return F.xxhash64("text").alias("row")


def _active(distinct: DataFrame) -> DataFrame:
    """Distinct lines that share an end with another distinct line."""
    ends = distinct.where("k0 is not null").select("h", F.explode(F.array("k0", "k1", "k2", "k3")).alias("k"))
    ends = ends.where("k is not null")
    shared = ends.groupBy("k").agg(F.min("h").alias("least"), F.max("h").alias("most"))
    shared = stored(shared.where("least <> most").select("k"), "shared_ends")
    return ends.join(shared, "k", "left_semi").select("h").distinct()


def _texts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``h, doc, line, text`` of the lines at ``places`` (``h, doc, row, line``)."""
    wanted = places.groupBy("doc", "row").agg(F.collect_list(F.struct("line", "h")).alias("lines"))
    wanted = stored(wanted, "wanted_lines")
    keyed = docs.select(_doc(), _row(), "text").where("text is not null")
    maybe, _ = split_by(keyed, F.col("row"), wanted, "row")
    # Repeated rows carry the same lines.
    found = maybe.join(wanted, ["doc", "row"]).withColumn("l", F.explode("lines"))
    text = F.element_at(F.split("text", "\n"), F.col("l.line") + 1)
    return found.select("l.h", "doc", "l.line", text.alias("text")).dropDuplicates(["h"])


def variants(lines: DataFrame) -> DataFrame:
    """``key, role, h, doc, line``: the deletion neighbourhood of each line, and the line itself."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = [batch.column(i).to_numpy() for i in range(3)]
            for start, _, data, offsets in slices(batch.column(3)):
                words, at = _words(data, offsets)
                of = rows_of(at, offsets)
                first = np.searchsorted(of, np.arange(len(offsets) - 1))
                n = np.diff(np.append(first, len(of)))
                place = np.arange(len(of)) - first[of]
                spans, count = Spans(words), n[of].astype(np.uint64)
                begin, index = first[of], np.arange(len(of))
                whole = spans(first, first + n)
                before = spans(begin, index)
                marked = whole[of] - words * powers(int(n.max(initial=0)) + 1)[place] + place.astype(np.uint64) * _GAP
                closed = before + (whole[of] - spans(begin, index + 1)) * _BACK
                keys = (
                    mixed(marked + count * _LENGTH) ^ _GAP,
                    mixed(closed + (count - np.uint64(1)) * _LENGTH),
                    mixed(whole + n.astype(np.uint64) * _LENGTH),
                )
                rows = (of, of, np.arange(len(n)))
                for key, role, row in zip(keys, (WILD, LONGER, BASE), rows):
                    columns = [pa.array(signed(key)), pa.array(np.full(len(key), role, np.int8))]
                    columns += [pa.array(other[row + start]) for other in others]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "role", "h", "doc", "line"])

    return lines.select("h", "doc", "line", "text").mapInArrow(task, "key long, role byte, h long, doc long, line int")


def one_word_apart(a: list[str], b: list[str]) -> bool:
    """Whether one word changed, added or removed makes ``a`` of ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    same = 0
    while same < len(a) and a[same] == b[same]:
        same += 1
    return a[same + 1 :] == b[same + 1 :] if len(a) == len(b) else a[same:] == b[same + 1 :]


def _split(text: str) -> list[bytes]:
    return text.encode().split()


@F.pandas_udf(BooleanType())
def _verified(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([one_word_apart(_split(x), _split(y)) for x, y in zip(a, b)], dtype=bool)


def near_repeats(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """``h`` of distinct lines whose first occurrence has an earlier neighbour, with that neighbour's ``h``."""
    active = stored(_active(distinct), "active_lines")
    places = distinct.join(active, "h", "left_semi").select("h", "first.doc", "first.row", "first.line")
    texts = stored(_texts(docs, places), "active_texts")
    emitted = stored(variants(texts), "line_variants")
    place = F.struct("doc", "line", "h")
    earliest = emitted.groupBy("key").agg(
        *[F.min(F.when(F.col("role") == role, place)).alias(f"of{role}") for role in (WILD, BASE, LONGER)],
        F.min("h").alias("least"),
        F.max("h").alias("most"),
    )
    earliest = stored(earliest.where("least <> most").drop("least", "most"), "earliest_variants")
    candidate = (
        F.when(F.col("role") == WILD, F.col(f"of{WILD}"))
        .when(F.col("role") == BASE, F.col(f"of{LONGER}"))
        .otherwise(F.col(f"of{BASE}"))
    )
    pairs = emitted.join(earliest, "key").select("h", place.alias("own"), candidate.alias("other"))
    pairs = pairs.where((F.col("other.h") != F.col("h")) & (F.struct("other.doc", "other.line") < F.struct("own.doc", "own.line")))
    pairs = pairs.groupBy("h").agg(F.min("other").alias("other")).select("h", F.col("other.h").alias("kept"))
    pairs = stored(pairs, "line_pairs")
    own = texts.select("h", F.col("text").alias("a"))
    other = texts.select(F.col("h").alias("kept"), F.col("text").alias("b"))
    return pairs.join(own, "h").join(other, "kept").where(_verified("a", "b")).select("h", "kept")


def removed_lines(docs: DataFrame, near_words: int = NEAR_WORDS, copy_share: float | None = None) -> DataFrame:
    """``doc, row, line`` of the lines that go; ``copy_share`` as in :func:`dedup_lines`."""
    lines = stored(lines_of(docs, near_words), "lines")
    distinct = lines.groupBy("h").agg(
        F.min(F.struct("doc", "line", "row")).alias("first"), F.count("*").alias("n"), *[F.max(k).alias(k) for k in ("k0", "k1", "k2", "k3")]
    )
    distinct = stored(distinct, "distinct_lines")
    near = near_repeats(docs, distinct)
    if copy_share is not None:
        of_kept = distinct.select(F.col("h").alias("kept"), F.col("first.doc").alias("near_owner"))
        near = stored(near, "near_lines").join(of_kept, "kept")
    near = near.drop("kept").withColumn("near", F.lit(True))
    # Lines that occur more than once, or have an earlier neighbour.
    marked = distinct.join(near, "h", "left").where("n > 1 or near")
    owner = [F.coalesce("near_owner", "first.doc").alias("owner")] if copy_share is not None else []
    marked = stored(marked.select("h", "near", F.col("first.doc").alias("_d"), F.col("first.line").alias("_l"), *owner), "repeated_lines")
    later = (F.col("doc") != F.col("_d")) | (F.col("line") != F.col("_l"))
    gone = lines.select("h", "doc", "row", "line", "words").join(marked, "h").where(F.coalesce("near", F.lit(False)) | later)
    if copy_share is not None:
        gone = _without_copies(lines, stored(gone.select("doc", "row", "line", "words", "owner"), "owned_lines"), copy_share)
    return gone.select("doc", "row", "line")


def _without_copies(lines: DataFrame, gone: DataFrame, share: float) -> DataFrame:
    """``gone`` but for the lines of documents whose owner has at least ``share`` of their words."""
    # A row for each repeated document and owner.
    owned = gone.where("owner <> doc").groupBy("doc", "row", "owner").agg(F.sum("words").alias("owned"))
    most = owned.groupBy("doc", "row").agg(F.max(F.struct("owned", F.bitwise_not("owner").alias("first"))).alias("most"))
    # Repeated rows have their lines twice, on both sides.
    totals = lines.groupBy("doc", "row").agg(F.sum("words").alias("total"))
    copies = most.join(totals, ["doc", "row"]).where(F.col("most.owned") >= share * F.col("total"))
    copies = copies.select("doc", "row", F.bitwise_not("most.first").alias("owner"))
    return gone.join(stored(copies, "copied_documents"), ["doc", "row", "owner"], "left_anti")


@F.pandas_udf(StringType())
def _without(text: pd.Series, lines: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else _rest(t, set(gone)) for t, gone in zip(text, lines)], dtype=object)


def _rest(text: str, gone: set[int]) -> str:
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)


# A filter on the text would otherwise be moved below it with a copy of the function, and every task would run it twice.
_without = _without.asNondeterministic()


def dedup_lines(docs: DataFrame, near_words: int = NEAR_WORDS, copy_share: float | None = None) -> DataFrame:
    """``docs`` without the lines that repeat earlier ones; adds ``n_lines`` (of the text before) and ``n_removed``.

    With ``copy_share``, a document of whose words at least this share (a half or more) repeats lines of one earlier
    document keeps the lines it has from there: it is a copy as a whole, for a step that judges whole documents.
    """
    columns = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    docs = docs.select(columns)
    by_doc = removed_lines(docs, near_words, copy_share).distinct().groupBy(F.col("doc").alias("_doc"), F.col("row").alias("_row"))
    by_doc = stored(by_doc.agg(F.collect_list("line").alias("_lines")), "removed_lines")
    keyed = docs.withColumns({"_doc": _doc(), "_row": _row()})
    maybe, unchanged = split_by(keyed, F.col("_row"), by_doc, "_row")
    joined = maybe.join(by_doc, ["_doc", "_row"], "left")
    some = F.col("_lines").isNotNull()
    rest = F.when(some, _without(F.col("text"), F.coalesce("_lines", F.array().cast("array<int>")))).otherwise(F.col("text"))
    n_lines = (F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1).cast("long")

    def shown(df: DataFrame, text: Column, removed: Column) -> DataFrame:
        values = [text.alias(c) if c.lower() == "text" else F.col(c) for c in columns]
        return df.select(*values, n_lines.alias("n_lines"), removed.cast("long").alias("n_removed"))

    changed = shown(joined, rest, F.when(some, F.size("_lines")).otherwise(0))
    return changed.unionByName(shown(unchanged, F.col("text"), F.lit(0)))


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs)
