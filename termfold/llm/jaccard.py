"""Similarity join of documents by the Jaccard index of their word shingles, with adaptive multi-match prefixes.

A document's shingles are ordered alike everywhere: those in crowded hash buckets last, then by hash. Two documents of
sizes x and y can only reach the threshold if they share at least a(x, y) shingles. If a document's prefix leaves out r
of its n shingles, a partner must share at least a - r shingles of the prefix. So a longer prefix asks for
correspondingly more matches. Each document takes the length whose estimated cost is lowest: postings to read, and
candidates, of which there are at most (matches expected) / (matches required). A pair is verified on the whole shingle
sets only if it has the matches that the shorter-reaching prefix of the two requires.

What is asked for are the groups that links connect, so pairs within a known group are not made. Documents with equal
word sequences are one node. In two rounds every node is compared with one neighbour (per shingle, the
first node of another group), which joins most of each group in a number of pairs linear in the postings. The remaining
pairs, of nodes that share a prefix shingle but no group yet, are then all counted and, where the count suffices, verified,
so no link between different groups is lost.

Bucket counts cover all documents (:data:`BUCKETS` numbers, the only thing the driver holds); they steer
the order and the lengths, never the result. Shingles are 64-bit hashes of the words' bytes, sequences 128-bit hashes.

Defined results: a null text or one without words has no shingles and links with nothing; a text of fewer words than a
shingle is one shingle. Rows that share a ``doc_id`` are one node, linked by whatever either links to. A null
``doc_id`` has no component and links with nothing. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfold.llm.arrays import BYTE_VALUES, Spans, list_column, lower_ascii, mixed, powers, signed, slices, word_bounds
from termfold.llm.components import components
from termfold.llm.filters import split_by
from termfold.session import stored

WORDS = 5
THRESHOLD = Fraction(4, 5)
BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
CHUNK = 4096
#: Longest prefixes have so many shingles more than the shortest.
LONGEST = 8
#: Cost of verifying a candidate, in postings.
VERIFYING = 4.0
#: Sequences that a task remembers to emit copies once.
REMEMBERED = 100_000
#: Nodes of a shingle that a list holds.
LISTED = 4096

_VALUES = lower_ascii(BYTE_VALUES)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its words' hashes and its distinct shingles, ascending."""
    starts, ends = word_bounds(data, offsets)
    hashes = mixed(Spans(_VALUES[data])(starts, ends))
    rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for i in range(words):
        rolled += mixed(hashes[i : len(hashes) - words + 1 + i] + np.uint64(i + 1))
    rolled = mixed(rolled)
    bounds = np.searchsorted(starts, offsets)
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        n = high - low
        if n >= words:
            yield hashes[low:high], np.unique(rolled[low : high - words + 1])
        elif n:
            whole = mixed(hashes[low:high] + np.arange(1, n + 1, dtype=np.uint64)).sum(dtype=np.uint64) + np.uint64(n)
            yield hashes[low:high], mixed(np.array([whole]))
        else:
            yield hashes[:0], rolled[:0]


def sequence_key(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits for a sequence of words."""
    n = len(hashes)
    return int((hashes * powers(n)).sum(dtype=np.uint64)), int((mixed(hashes + np.uint64(7)) * powers(n)).sum(dtype=np.uint64))


_SURVEY = "doc_id long, n int, a long, b long, chunk int, part int, counts binary"
_ARROW_SURVEY = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int32()), ("a", pa.int64()), ("b", pa.int64())]
    + [("chunk", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())]
)


def _survey(docs: DataFrame, words: int) -> DataFrame:
    """A row for each document (size and sequence key), and each task's bucket counts in chunks."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        counts = np.zeros(BUCKETS, np.int32)
        for batch in batches:
            rows: list[tuple[int, int, int]] = []
            for _, _, data, offsets in slices(batch.column(1)):
                for hashes, shingles in shingle_sets(data, offsets, words):
                    rows.append((len(shingles), *sequence_key(hashes)))
                    counts[(shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)] += 1
            n, a, b = (np.array(x, t) for x, t in zip(zip(*rows), (np.int32, np.uint64, np.uint64))) if rows else ([], [], [])
            if rows:
                none = [pa.nulls(len(rows), t) for t in (pa.int32(), pa.int32(), pa.binary())]
                columns = [batch.column(0), pa.array(n), pa.array(signed(a)), pa.array(signed(b)), *none]
                yield pa.RecordBatch.from_arrays(columns, schema=_ARROW_SURVEY)
        if counts.any():
            parts = counts.reshape(-1, CHUNK)
            none = [pa.nulls(len(parts), t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())]
            columns = [*none, pa.array(np.arange(len(parts), dtype=np.int32)), pa.array(np.full(len(parts), part, np.int32))]
            columns.append(pa.array([c.tobytes() for c in parts], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=_ARROW_SURVEY)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, _SURVEY)


def _summed(width: type):
    def total(table: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(c, width).astype(np.int64) for c in table.column("counts").to_pylist())
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "counts": pa.array([sums.tobytes()], pa.binary())})

    return total


def bucket_classes(survey: DataFrame) -> np.ndarray:
    """By bucket: 0 for usual counts, then four classes for each doubling of what is above the usual.

    The tasks' counts are summed in groups of at most a thousand, then the sums.
    """
    chunks = survey.where("chunk is not null").select("chunk", (F.col("part") % 1000).alias("part"), "counts")
    some = chunks.groupBy("chunk", "part").applyInArrow(_summed(np.int32), "chunk int, counts binary")
    every = some.groupBy("chunk").applyInArrow(_summed(np.int64), "chunk int, counts binary")
    counts = np.zeros(BUCKETS, np.int64)
    for row in every.collect():
        counts[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(row.counts, np.int64)
    usual = np.median(counts)
    above = np.maximum(counts - usual - 4 * np.sqrt(usual) - 1, 0)
    return np.round(4 * np.log2(above + 1)).astype(np.uint8)


def prefix_length(n: int, others: np.ndarray, threshold: Fraction = THRESHOLD) -> int:
    """Length of the prefix of a set of ``n``; ``others``: documents expected behind each shingle, in order."""
    least = -(-threshold.numerator * n // threshold.denominator)
    shortest = n - least + 1
    longest = min(n, shortest + LONGEST)
    expected = np.cumsum(others[:longest])[shortest - 1 :]
    required = np.arange(1, len(expected) + 1)
    lengths = shortest - 1 + required
    return int(lengths[np.argmin(lengths + expected + VERIFYING * expected / required)])


_POSTINGS = "token long, doc_id long, n int, p int"


def postings(docs: DataFrame, classes: np.ndarray, words: int = WORDS, threshold: Fraction = THRESHOLD) -> DataFrame:
    """``token, doc_id, n, p``: the prefix shingles of each text; a task emits equal word sequences once."""
    sent = docs.sparkSession.sparkContext.broadcast(classes)
    expected = 2.0 ** (np.arange(256) / 4) - 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = sent.value
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            tokens, owners, sizes, lengths = [], [], [], []
            for start, _, data, offsets in slices(batch.column(1)):
                for row, (hashes, shingles) in enumerate(shingle_sets(data, offsets, words), start):
                    key = sequence_key(hashes)
                    if not len(shingles) or key in seen:
                        continue
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(key)
                    crowd = classes[(shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
                    order = np.argsort(crowd, kind="stable")
                    n = len(shingles)
                    p = prefix_length(n, expected[crowd[order]], threshold)
                    tokens.append(shingles[order[:p]])
                    owners.append(ids[row])
                    sizes.append(n)
                    lengths.append(p)
            if tokens:
                repeat = lambda x, t: pa.array(np.repeat(np.array(x, t), lengths))
                columns = [pa.array(signed(np.concatenate(tokens))), repeat(owners, np.int64), repeat(sizes, np.int32), repeat(lengths, np.int32)]
                yield pa.RecordBatch.from_arrays(columns, names=["token", "doc_id", "n", "p"])

    used = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    return used.mapInArrow(task, _POSTINGS)


def _copies(survey: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, node`` of documents whose only text occurs before: its first document; and ids that several texts tie.

    The second is ``node, component``, for ids with several different texts and the first documents of these texts.
    """
    sized = survey.where("chunk is null and n > 0 and doc_id is not null").select("doc_id", "a", "b")
    firsts = sized.groupBy("a", "b").agg(F.min("doc_id").alias("node"), F.count("*").alias("times"))
    firsts = stored(firsts.where("times > 1").drop("times"), "first_copies")
    copies = stored(sized.join(firsts, ["a", "b"]).where("doc_id <> node").select("doc_id", "node").distinct(), "copies")
    texts = sized.groupBy("doc_id").agg(F.min(F.struct("a", "b")).alias("least"), F.max(F.struct("a", "b")).alias("most"))
    several = stored(texts.where("least <> most").select("doc_id"), "ids_of_several_texts")
    if not several.limit(1).count():
        return copies, survey.sparkSession.range(0).selectExpr("id AS node", "id AS component")
    tied = copies.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("x"), F.col("node").alias("y"))
    return stored(copies.join(several, "doc_id", "left_anti"), "copies"), components(tied)


def _required(a: str, b: str, threshold: Fraction) -> Column:
    """Matches that two rows with sizes and prefix lengths ``n, p`` must have."""
    p, q = threshold.numerator, threshold.denominator
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    shared = F.floor((p * (n + m) + p + q - 1) / (p + q))
    return F.greatest(F.lit(1), shared + F.least(F.col(f"{a}.p") - n, F.col(f"{b}.p") - m))


def _sizes_fit(a: str, b: str, threshold: Fraction) -> Column:
    p, q = threshold.numerator, threshold.denominator
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return F.least(n, m) * q >= F.greatest(n, m) * p


def verified(docs: DataFrame, pairs: DataFrame, words: int, threshold: Fraction) -> DataFrame:
    """The pairs ``x, y`` of ids whose texts' shingle sets reach the threshold."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in slices(batch.column(1)):
                sets = [s for _, s in shingle_sets(data, offsets, words)]
                lists = list_column(signed(np.concatenate(sets)), np.cumsum([0, *map(len, sets)]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), lists], names=["id", "set"])

    asked = stored(pairs.select(F.col("x").alias("id")).union(pairs.select("y")).distinct(), "pair_members")
    ids = F.col("doc_id").cast("long")
    maybe, _ = split_by(docs.select(ids.alias("id"), "text").where("text is not null"), F.col("id"), asked, "id")
    sets = stored(maybe.join(asked, "id", "left_semi").mapInArrow(task, "id long, set array<long>"), "shingle_sets")
    both = pairs.join(sets.select(F.col("id").alias("x"), F.col("set").alias("sx")), "x")
    both = both.join(sets.select(F.col("id").alias("y"), F.col("set").alias("sy")), "y")
    shared = F.size(F.array_intersect("sx", "sy"))
    union = F.size("sx") + F.size("sy") - shared
    fits = shared * threshold.denominator >= union * threshold.numerator
    return both.where(fits & (shared > 0)).select("x", "y").distinct()


def _grouped(shared: DataFrame, known: DataFrame) -> DataFrame:
    """Postings with the group of their node."""
    joined = shared.join(known.withColumnRenamed("component", "group"), "node", "left")
    return joined.select("token", "node", "n", "p", F.coalesce("group", "node").alias("group"))


def _ends(grouped: DataFrame, by: Column) -> DataFrame:
    """Shingles that more than one group has, with a node of the first and one of the last group."""
    member = F.struct("group", by.alias("by"), "node", "n", "p")
    ends = grouped.groupBy("token").agg(F.min(member).alias("low"), F.max(member).alias("high"))
    return stored(ends.where("low.group <> high.group"), "mixed_shingles")


def links(
    docs: DataFrame, survey: DataFrame, copies: DataFrame, known: DataFrame, words: int, threshold: Fraction
) -> DataFrame:
    """``node, component`` of the nodes that have links, from the groups known before."""
    classes = bucket_classes(survey)
    every = stored(postings(docs, classes, words, threshold), "postings")
    shared = every.groupBy("token").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = stored(shared.where("low <> high").select("token"), "shared_shingles")
    shared = every.join(shared, "token", "left_semi").join(copies, "doc_id", "left")
    shared = shared.select("token", F.coalesce("node", "doc_id").alias("node"), "n", "p")
    # Different texts of one id differ in n and p, or count as one at first and are told apart when they are verified.
    shared = stored(shared.distinct(), "shared_postings")

    for turn in range(2):
        # Another node of each group in each round, as not every member is linked with all others.
        grouped = _grouped(shared, known)
        rest = grouped.join(_ends(grouped, F.xxhash64(F.lit(turn), "node")), "token")
        other = F.when(F.col("low.group") != F.col("group"), F.col("low")).otherwise(F.col("high"))
        near = rest.select(F.struct("node", "n", "p").alias("own"), other.alias("other"))
        near = near.where(_sizes_fit("own", "other", threshold))
        pairs = near.groupBy("own", F.struct("other.node", "other.n", "other.p").alias("other")).count()
        pairs = pairs.where(F.col("count") >= _required("own", "other", threshold))
        best = pairs.groupBy("own.node").agg(F.max(F.struct("count", "other.node")).alias("best"))
        best = stored(best.select(F.col("node").alias("x"), F.col("best.node").alias("y")), "near_pairs")
        known = _joined(known, verified(docs, best, words, threshold))

    left = stored(_remaining_pairs(_grouped(shared, known), threshold), "remaining_pairs")
    return _joined(known, verified(docs, left, words, threshold))


_MEMBER = ("node", "n", "p", "size", "group")


def _remaining_pairs(grouped: DataFrame, threshold: Fraction) -> DataFrame:
    """``x, y`` of different groups whose prefixes share what the pair requires.

    A pair is counted from the side of the smaller group. Every node outside a shingle's largest group meets the nodes
    of that shingle as lists, block by block (a block of nodes has at most about :data:`LISTED` in a list). The
    matches of a node with all nodes of a block are counted at once, and only pairs with enough of them become rows.
    """
    of = grouped.groupBy("token").agg(F.min("group").alias("least"), F.max("group").alias("most"))
    rest = grouped.join(stored(of.where("least <> most").select("token"), "mixed_shingles"), "token", "left_semi")
    rest = stored(rest, "mixed_postings")
    sizes = stored(rest.groupBy("group").agg(F.count("*").alias("size")), "group_sizes")
    rest = stored(rest.join(sizes, "group").select("token", *_MEMBER), "remaining_postings")
    largest = rest.groupBy("token").agg(F.max(F.struct("size", "group")).alias("largest"), F.count("*").alias("all"))
    largest = stored(largest, "largest_groups")
    longest = largest.agg(F.max("all").alias("n")).first().n or 0
    block = F.pmod(F.xxhash64("node"), F.lit(1 + longest // LISTED)).alias("block")
    lists = rest.groupBy("token", block).agg(F.collect_list(F.struct(*_MEMBER)).alias("others"))
    probes = rest.join(largest, "token").where(F.col("group") != F.col("largest.group")).select("token", *_MEMBER)
    num, den = threshold.numerator, threshold.denominator

    def may_link(x: Column) -> Column:
        after = (x["size"] > F.col("size")) | ((x["size"] == F.col("size")) & (x["group"] > F.col("group")))
        return after & (F.least("n", x["n"]) * den >= F.greatest("n", x["n"]) * num)

    partners = F.transform(F.filter("others", may_link), lambda x: F.struct(x["node"], x["n"], x["p"]))
    met = probes.join(lists, "token").select("node", "n", "p", "block", partners.alias("others"))
    met = met.where(F.size("others") > 0).repartition("node", "block").sortWithinPartitions("node", "block", "n", "p")

    def matched(own: tuple, lists: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
        node, n, p = own
        others = pa.concat_arrays(lists)
        columns = [others.field(i).to_numpy().astype(np.int64) for i in range(3)]
        order = np.lexsort((columns[2], columns[1], columns[0]))
        other, m, q = (x[order] for x in columns)
        first = np.ones(len(other), bool)
        first[1:] = (other[1:] != other[:-1]) | (m[1:] != m[:-1]) | (q[1:] != q[:-1])
        first = np.flatnonzero(first)
        count = np.diff(np.append(first, len(other)))
        other, m, q = other[first], m[first], q[first]
        required = np.maximum(1, (num * (n + m) + num + den - 1) // (num + den) + np.minimum(p - n, q - m))
        other = other[count >= required]
        return np.minimum(node, other), np.maximum(node, other)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, lists = None, None, []

        def counted_pairs() -> Iterator[pa.RecordBatch]:
            if lists:
                yield pa.record_batch([pa.array(x) for x in matched(own, lists)], ["x", "y"])

        for batch in batches:
            others = batch.column(4)
            for i, row in enumerate(zip(*(batch.column(j).to_pylist() for j in range(4)))):
                if row != key:
                    yield from counted_pairs()
                    key, own, lists = row, row[:3], []
                lists.append(others[i].values)
        yield from counted_pairs()

    return met.mapInArrow(task, "x long, y long").distinct()


def _joined(known: DataFrame, edges: DataFrame) -> DataFrame:
    """Groups after adding links."""
    before = known.select(F.col("node").alias("x"), F.col("component").alias("y")).where("x <> y")
    return components(edges.select("x", "y").unionByName(before))


def near_duplicates(docs: DataFrame, words: int = WORDS, threshold: Fraction = THRESHOLD) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    survey = stored(_survey(docs, words), "survey")
    copies, tied = _copies(survey)
    groups = links(docs, survey, copies, tied, words, threshold)
    rows = survey.where("chunk is null").select("doc_id", F.col("n").cast("long").alias("n_shingles"))
    named = rows.join(copies, "doc_id", "left").withColumn("node", F.coalesce("node", "doc_id"))
    found = named.join(groups, "node", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))


def op5_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
