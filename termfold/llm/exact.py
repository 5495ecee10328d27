"""Exact dedup with Patricia-trie owners.

Texts are dealt to partitions by length and content hash. In every partition the full byte strings go into compressed
radix tries (edges carry runs of bytes); equal strings end in the same terminal node, which holds the best identifier
seen there. No hash decides equality: a hash only says which trie a string goes to.

Two rounds. In the first a task inserts the texts it scans, partition by partition, and writes a row for each document;
one document of each terminal, its leader, keeps the text. So copies within a task are one string before anything is
moved. When the tries hold more than :data:`HELD_BYTES`, the subtree with the most bytes is written out as it stands and
forgotten: a later copy opens a new terminal there. In the second round only strings whose length and hash occur at more
than one leader move, sorted by both; tries then hold the strings of one length and hash at a time and are written out
when these end, as no further string can reach that subtree.

Defined results: a null text counts as empty, and the empty text is a text like others. Of equal texts the row with the
largest identifier stays (``owner="smallest"``: the smallest); a null identifier loses against every other. Of rows that
tie exactly one stays. Nothing is folded or trimmed: the bytes decide. Other columns are ignored by :func:`owners`, and
:func:`dedup` keeps them; its own columns replace columns of the same names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfold.llm.filters import split_by
from termfold.session import stored

#: Bytes of strings that the tries of a task hold before a subtree is written out.
HELD_BYTES = 48 << 20
#: Tries of a task in the first round; a string's trie is chosen by its length and hash.
PARTITIONS = 16
_STEP = 256
_LOWEST = -(1 << 63)

_LEADERS = (
    "id long, leader long, of_leader long, n long, h long, sha binary, best long, copies long, text binary"
)
_ARROW_LEADERS = pa.schema(
    [(k, pa.int64()) for k in ("id", "leader", "of_leader", "n", "h")]
    + [("sha", pa.binary()), ("best", pa.int64()), ("copies", pa.int64()), ("text", pa.binary())]
)


class Node:
    """An edge and what lies behind it: bytes on the edge, children by first byte, the rows that end here."""

    __slots__ = ("label", "children", "rows", "held")

    def __init__(self, label: bytes, rows: list | None = None):
        self.label = label
        self.children: dict[int, Node] = {}
        self.rows = rows
        self.held = len(label)


def shared_length(a: bytes, at: int, b: bytes) -> int:
    """How many bytes of ``b`` agree with ``a`` from ``at`` on."""
    most = min(len(a) - at, len(b))
    if a[at : at + most] == b[:most]:
        return most
    low = 0
    while a[at + low : at + low + _STEP] == b[low : low + _STEP]:
        low += _STEP
    high = min(low + _STEP, most)
    # The first difference lies in the block from low on.
    while high - low > 1:
        middle = (low + high) // 2
        if a[at + low : at + middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class Trie:
    """A compressed radix trie over byte strings; rows are added at the terminal of their string."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, text: bytes, row) -> int:
        """Add ``row`` at ``text``; the bytes by which the trie has grown."""
        node, at, path = self.root, 0, []
        while at < len(text):
            path.append(node)
            child = node.children.get(text[at])
            if child is None:
                leaf = Node(text[at:], [row])
                node.children[text[at]] = leaf
                return self._grown(path, len(leaf.label))
            same = shared_length(text, at, child.label)
            if same < len(child.label):
                upper = Node(child.label[:same])
                upper.held = child.held
                child.held -= same
                child.label = child.label[same:]
                upper.children[child.label[0]] = child
                node.children[text[at]] = upper
                child = upper
            node, at = child, at + same
        if node.rows is None:
            node.rows = []
        node.rows.append(row)
        return 0

    @staticmethod
    def _grown(path: list[Node], by: int) -> int:
        for node in path:
            node.held += by
        return by

    def take(self, first: int | None = None) -> Iterator[tuple[bytes, list]]:
        """Remove the subtree below the root's edge ``first`` (None: everything) and give its strings and rows."""
        if first is None:
            tops, self.root = [self.root], Node(b"")
        else:
            tops = [self.root.children.pop(first)]
            self.root.held -= tops[0].held
        stack = [(top, b"") for top in tops]
        while stack:
            node, before = stack.pop()
            text = before + node.label
            if node.rows:
                yield text, node.rows
            stack += [(child, text) for child in node.children.values()]

    def largest(self) -> tuple[int, int]:
        """Bytes and first byte of the subtree that holds the most."""
        return max(((child.held, first) for first, child in self.root.children.items()), default=(0, 0))


def text_keys(text: Column) -> tuple[Column, Column, Column]:
    """Bytes, length and content hash of a text."""
    data = F.coalesce(text, F.lit("")).cast("string").cast("binary")
    return data, F.octet_length(data).cast("long"), F.xxhash64(data)


def leaders(docs: DataFrame, id_column: str = "doc_id", text: str = "text", owner: str = "largest") -> DataFrame:
    """First round: a row for each document with the leader of its text in this task, see ``_LEADERS``.

    ``best`` and ``copies`` are those of the leader's rows, ``of_leader`` marks the row that is the best of them, and
    ``text`` is null but in the leader's own row.
    """
    held_bytes, partitions, sign = HELD_BYTES, PARTITIONS, _sign(owner)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        tries = [Trie() for _ in range(partitions)]
        held, number = 0, 0

        def closed(strings: Iterator[tuple[bytes, list]]) -> Iterator[pa.RecordBatch]:
            """``held_bytes`` of strings at most in a batch."""
            out, size = [[] for _ in _ARROW_LEADERS], 0
            for string, rows in strings:
                best = max(rows)
                sha = hashlib.sha256(string).digest()
                for i, row in enumerate(rows):
                    values = (
                        None if row[0] == _LOWEST else sign * row[0], base + rows[0][1], int(row is best), rows[0][2], rows[0][3],
                        sha, None if best[0] == _LOWEST else sign * best[0], len(rows), None if i else string,
                    )
                    for column, value in zip(out, values):
                        column.append(value)
                size += len(string) + 100 * len(rows)
                if size > held_bytes // 8:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _ARROW_LEADERS)], schema=_ARROW_LEADERS)
                    out, size = [[] for _ in _ARROW_LEADERS], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _ARROW_LEADERS)], schema=_ARROW_LEADERS)

        for batch in batches:
            ids, lengths, hashes = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for i, string in enumerate(batch.column(1)):
                row = (_LOWEST if ids[i] is None else sign * ids[i], number, lengths[i], hashes[i])
                number += 1
                held += 32 + tries[(hashes[i] ^ lengths[i]) % partitions].insert(string.as_py(), row)
                while held > held_bytes:
                    fullest = max(tries, key=lambda t: t.root.held)
                    size, first = fullest.largest()
                    if not size:
                        break  # nothing but empty strings
                    yield from closed(fullest.take(first))
                    held = sum(t.root.held for t in tries)
        for trie in tries:
            yield from closed(trie.take())

    data, length, content = text_keys(F.col(text))
    used = docs.select(F.col(id_column).cast("long").alias("id"), data.alias("data"), length.alias("n"), content.alias("h"))
    return used.mapInArrow(task, _LEADERS)


def _sign(owner: str) -> int:
    if owner not in ("largest", "smallest"):
        raise ValueError(f"owner is largest or smallest, not {owner!r}")
    return 1 if owner == "largest" else -1


def met_leaders(found: DataFrame, owner: str = "largest") -> DataFrame:
    """Second round: ``leader, first, owner, size`` of the leaders whose length and hash another leader has too.

    ``first`` is the leader whose best row stays. A string's leaders are at most as many as the tasks and the subtrees
    they have written out.
    """
    sign = _sign(owner)
    met = found.where("text is not null").groupBy("n", "h").agg(F.count("*").alias("leaders"))
    met = stored(met.where("leaders > 1").select("n", "h"), "met_keys")
    mixed_key = F.xxhash64("n", "h")
    maybe, _ = split_by(found.where("text is not null"), mixed_key, met.withColumn("k", mixed_key), "k")
    moved = maybe.join(met, ["n", "h"], "left_semi").select("n", "h", "leader", "best", "copies", "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, last = Trie(), None
        out: list[tuple] = []
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            rows = list(zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))))
            for key, (leader, best, copies), string in zip(keys, rows, batch.column(5)):
                if key != last:
                    out += settled(trie)
                    last = key
                trie.insert(string.as_py(), (_LOWEST if best is None else sign * best, -leader, copies))
            yield shown(out)
            out = []
        yield shown(settled(trie))

    def settled(trie: Trie) -> list[tuple]:
        out = []
        for _, rows in trie.take():
            best, first, _ = max(rows)
            size = sum(row[2] for row in rows)
            out += [(-row[1], -first, None if best == _LOWEST else sign * best, size) for row in rows]
        return out

    def shown(rows: list[tuple]) -> pa.RecordBatch:
        names = ("leader", "first", "owner", "size")
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(names))

    ordered = moved.repartition("n", "h").sortWithinPartitions("n", "h")
    return ordered.mapInArrow(task, "leader long, first long, owner long, size long")


def owners(docs: DataFrame, id_column: str = "doc_id", text: str = "text", owner: str = "largest") -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256`` for each row of ``docs``."""
    found = stored(leaders(docs, id_column, text, owner), "text_leaders")
    met = stored(met_leaders(found, owner), "met_leaders")
    rows = found.drop("text")
    maybe, alone = split_by(rows, F.col("leader"), met, "leader")
    joined = maybe.join(met, "leader", "left")
    apart = F.col("first").isNull()
    first = F.coalesce("first", "leader")

    def shown(df: DataFrame, keep: Column, size: Column, kept: Column) -> DataFrame:
        sha = F.lower(F.hex("sha")).alias("text_sha256")
        return df.select("id", keep.alias("keep_id"), size.alias("group_size"), kept.alias("kept"), sha)

    of_leader = F.col("of_leader") == 1
    some = shown(
        joined,
        F.when(apart, F.col("best")).otherwise(F.col("owner")),
        F.coalesce("size", "copies"),
        of_leader & (first == F.col("leader")),
    )
    return some.unionByName(shown(alone, F.col("best"), F.col("copies"), of_leader))


def dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text", owner: str = "largest") -> DataFrame:
    """One row of ``docs`` for each distinct text, with all columns, and ``group_size``.

    Rows are found again by identifier and text. Of rows that agree in both the one that is first in the order of their
    other columns' hash stays.
    """
    shown = [c for c in docs.columns if c.lower() != "group_size"]
    keep = owners(docs, id_column, text, owner).where("kept")
    keep = stored(keep.select(F.col("id").alias("_id"), "group_size", F.col("text_sha256").alias("_sha")), "kept_texts")
    data = text_keys(F.col(text))[0]
    keyed = docs.select(*shown, F.col(id_column).cast("long").alias("_id"), F.sha2(data, 256).alias("_sha"))
    same = keyed["_id"].eqNullSafe(keep["_id"]) & (keyed["_sha"] == keep["_sha"])
    found = keyed.join(keep, same).select(*[keyed[c] for c in shown], keyed["_id"], keyed["_sha"], keep["group_size"])
    row = F.struct(*[F.col(c) for c in shown], "group_size")
    one = found.groupBy("_id", "_sha").agg(F.min_by(row, F.xxhash64(*shown)).alias("_row"))
    return one.select("_row.*")


def op12_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return owners(docs).withColumnRenamed("id", "doc_id")


#: The same with windows over the texts.
OP12_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
