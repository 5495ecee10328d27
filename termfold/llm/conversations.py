"""Prefix trie over conversations with vertical bitmaps.

Turns are numbered within their conversation. Conversations are dealt to shards of :data:`SHARD` in the order of their
ids, positions to windows of :data:`WINDOW`. A task takes one shard and window and holds a vertical index: for each
(position, turn) a bitset of the shard's conversations. Going down depth first, the bitset of a node meets the postings of
the next position; each meeting that is not empty is a child, its population count the child's members in this shard, and
the members without a further turn are its end list. A node is named by a digest of its turns, so the shards' parts of one
node are summed by Spark afterwards, map-side first.

A turn is known by the SHA-256 of its role and text, a path by a SHA-256 over those: texts are never moved. What a long
conversation has before a window comes in as one digest per window, chained in a streamed pass. So a task holds at most
``SHARD * WINDOW`` turns, however long a conversation is.

Sums over subtrees need only nodes of two or more members: a node of one member starts a chain with one leaf and nothing
saved. Over the others, every node sends its sum to the ancestor 1, 2, 4, ... levels up until no node is that deep.

Defined results: rows without a conversation id take no part. A null turn comes first; null role or text is empty. Rows of
one conversation and turn are in the order of their digests, repeated rows are turns of their own. Other columns are
ignored. A conversation without a turn belongs to the root and ends there; an empty table has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termfold.operators.ranking import ranked
from termfold.session import stored

#: Conversations of a shard, the length of a bitset.
SHARD = 1024
#: Positions of a window.
WINDOW = 64
ROOT = hashlib.sha256(b"root").digest()

_NODES = "key binary, parent binary, depth long, n long, conv long, bytes long, shard long, ends array<long>"
_ARROW_NODES = pa.schema(
    [("key", pa.binary()), ("parent", pa.binary())]
    + [(k, pa.int64()) for k in ("depth", "n", "conv", "bytes", "shard")]
    + [("ends", pa.list_(pa.int64()))]
)


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 of a turn; the length of the role keeps the two apart."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    size = F.octet_length(role).cast("string")
    return F.unhex(F.sha2(F.concat(size, F.lit(":"), role, text).cast("binary"), 256))


def numbered_turns(rows: DataFrame) -> DataFrame:
    """``conv, pos, digest, bytes``: the turns of each conversation from 1, also of a very long one in many tasks."""
    turns = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        turn_digest(F.col("role"), F.col("text")).alias("digest"),
        F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("bytes"),
    )
    order = [F.asc_nulls_first("turn"), "digest"]
    return ranked(turns, order, within=["conv"], name="pos").select("conv", F.col("pos").cast("long").alias("pos"), "digest", "bytes")


def _sharded(lengths: DataFrame) -> DataFrame:
    """``lengths`` (``conv, ...``) with the shard of each conversation."""
    numbered = ranked(lengths, ["conv"], name="place")
    return numbered.withColumn("shard", F.floor((F.col("place") - 1) / SHARD).cast("long")).drop("place")


def _long_starts(turns: DataFrame) -> DataFrame:
    """``conv, window, start``: the digest of all turns before each further window of a conversation."""
    long = turns.where(F.col("total") > WINDOW).where(F.col("pos") <= F.floor((F.col("total") - 1) / WINDOW) * WINDOW)
    window = F.floor((F.col("pos") - 1) / WINDOW).cast("long")
    turn = F.struct("pos", "digest")
    # At most WINDOW turns in a group.
    blocks = long.groupBy("conv", window.alias("window")).agg(F.sort_array(F.collect_list(turn))["digest"].alias("digests"))
    block = F.unhex(F.sha2(F.aggregate("digests", F.lit(b""), lambda all_, one: F.concat(all_, one)), 256))
    blocks = blocks.select("conv", "window", block.alias("block"))

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, start = None, ROOT
        for batch in batches:
            starts = []
            for conv, digest in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if conv != last:
                    last, start = conv, ROOT
                start = hashlib.sha256(start + digest).digest()
                starts.append(start)
            windows = pa.array([w + 1 for w in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), windows, pa.array(starts, pa.binary())], names=["conv", "window", "start"])

    ordered = blocks.repartition("conv").sortWithinPartitions("conv", "window")
    return ordered.mapInArrow(chained, "conv long, window long, start binary")


class Vertical:
    """Of one shard and window: bitsets of conversations by (position, turn) and by position, and each one's turns."""

    def __init__(self, positions: list[int], places: list[int], turns: list[bytes]):
        self.postings: dict[tuple[int, bytes], int] = {}
        self.present: dict[int, int] = {}
        self.turn_at: dict[tuple[int, int], bytes] = {}
        for p, o, turn in zip(positions, places, turns):
            self.postings[p, turn] = self.postings.get((p, turn), 0) | 1 << o
            self.present[p] = self.present.get(p, 0) | 1 << o
            self.turn_at[p, o] = turn

    def walk(self, starts: dict[bytes, int], first: int, ending: dict[int, int]) -> Iterator[tuple]:
        """Depth first from the nodes ``starts`` (name to bitset) at ``first``: ``key, parent, depth, bitset, ends``."""
        for start, bits in starts.items():
            stack = [(start, first + 1, bits, hashlib.sha256())]
            while stack:
                parent, depth, left, inner = stack.pop()
                while left:
                    turn = self.turn_at[depth, (left & -left).bit_length() - 1]
                    child = left & self.postings[depth, turn]
                    left ^= child
                    path = inner.copy()
                    path.update(turn)
                    key = hashlib.sha256(start + path.digest()).digest()
                    ends = child & ending.get(depth, 0)
                    yield key, parent, depth, child, ends
                    if going := child & ~ends & self.present.get(depth + 1, 0):
                        stack.append((key, depth + 1, going, path))


def members(bits: int) -> list[int]:
    out = []
    while bits:
        low = bits & -bits
        out.append(low.bit_length() - 1)
        bits ^= low
    return out


def shard_nodes(turns: DataFrame) -> DataFrame:
    """Parts of nodes, see ``_NODES``, from ``shard, window, start, conv, pos, total, digest, bytes``."""

    def task(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        convs, pos, total = (table.column(k).to_numpy() for k in ("conv", "pos", "total"))
        shard, window = table.column("shard")[0].as_py(), table.column("window")[0].as_py()
        digests, sizes = table.column("digest").to_pylist(), table.column("bytes").to_numpy()
        ids, of = np.unique(convs, return_inverse=True)
        of_list, pos_list = of.tolist(), pos.tolist()
        index = Vertical(pos_list, of_list, digests)
        starts: dict[bytes, int] = {}
        for o, p, start in zip(of_list, pos_list, table.column("start").to_pylist()):
            if p == window * WINDOW + 1:
                starts[start] = starts.get(start, 0) | 1 << o
        ending: dict[int, int] = {}
        for i in np.flatnonzero(pos == total):
            ending[pos_list[i]] = ending.get(pos_list[i], 0) | 1 << of_list[i]
        length = {(p, o): s for p, o, s in zip(pos_list, of_list, sizes.tolist())}
        out = [[] for _ in _ARROW_NODES]
        for key, parent, depth, bits, ends in index.walk(starts, window * WINDOW, ending):
            lowest = (bits & -bits).bit_length() - 1
            listed = ids[members(ends)].tolist() if ends else None
            row = (key, parent, depth, bits.bit_count(), int(ids[lowest]), length[depth, lowest], shard, listed)
            for column, value in zip(out, row):
                column.append(value)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(out, _ARROW_NODES)], schema=_ARROW_NODES)

    return turns.groupBy("shard", "window").applyInArrow(task, _NODES)


def _root_parts(convs: DataFrame) -> DataFrame:
    """The root's part of each shard."""
    turnless = F.sort_array(F.collect_list(F.when(F.col("total") == 0, F.col("conv"))))
    # At most SHARD ids in a list.
    parts = convs.groupBy("shard").agg(F.count("*").alias("n"), F.min("conv").alias("conv"), turnless.alias("ends"))
    return parts.select(
        F.lit(ROOT).alias("key"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("depth"),
        "n",
        "conv",
        F.lit(0).cast("long").alias("bytes"),
        "shard",
        F.when(F.size("ends") > 0, F.col("ends")).alias("ends"),
    )


def end_digests(parts: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of nodes with end lists. Shards follow each other in id order, so lists are only streamed."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, running = None, None

        def shown(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], names=["key", "ends_sha256"]
            )

        for batch in batches:
            done = []
            for key, listed in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                text = ",".join(map(str, listed)).encode()
                if key != last:
                    if last is not None:
                        done.append((last, running.hexdigest()))
                    last, running = key, hashlib.sha256(text)
                else:
                    running.update(b"," + text)
            yield shown(done)
        yield shown([(last, running.hexdigest())] if last is not None else [])

    listed = parts.where("ends is not null").select("key", "shard", "ends")
    return listed.repartition("key").sortWithinPartitions("key", "shard").mapInArrow(task, "key binary, ends_sha256 string")


def subtree_sums(shared: DataFrame) -> DataFrame:
    """``key, leaves, saved`` summed over subtrees, from ``key, parent, depth, leaves, saved``.

    After k rounds a node's sums cover the descendants less than 2^k levels below it, and ``parent`` is the ancestor
    2^k levels up. Nodes that are not that deep send nothing more.
    """
    nodes = shared
    deepest = shared.agg(F.max("depth")).first()[0] or 0
    reach = 1
    while reach <= deepest:
        sending = nodes.where(F.col("depth") >= reach)
        sums = sending.groupBy(F.col("parent").alias("key")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        up = nodes.where((F.col("depth") >= reach) & (F.col("depth") < deepest)).select(F.col("key").alias("parent"), F.col("parent").alias("above"))
        # Who would pass the root is done.
        climbing = nodes.where(F.col("depth") >= 2 * reach).join(up, "parent").select("key", "above")
        total = (
            nodes.join(sums, "key", "left")
            .join(climbing, "key", "left")
            .select(
                "key",
                F.col("above").alias("parent"),
                "depth",
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            )
        )
        nodes = stored(total, "subtree_sums")
        reach *= 2
    return nodes.select("key", "leaves", "saved")


def prefix_trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes of all conversations' prefixes.

    ``turns``: ``conv, pos, digest, bytes`` with positions from 1 without gaps; ``lengths``: ``conv, total`` of every
    conversation, those without a turn included. Columns of the result as in :func:`op13_conversation_trie`.
    """
    convs = stored(_sharded(lengths), "sharded_conversations")
    placed = stored(turns.join(convs, "conv"), "placed_turns")
    window = F.floor((F.col("pos") - 1) / WINDOW).cast("long")
    starts = stored(_long_starts(placed), "window_starts")
    placed = placed.withColumn("window", window)
    first = placed.where("window = 0").withColumn("start", F.lit(ROOT))
    later = placed.where("window > 0").join(starts, ["conv", "window"])
    parts = shard_nodes(first.unionByName(later)).unionByName(_root_parts(convs))
    parts = stored(parts, "node_parts")
    merged = parts.groupBy("key").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.sum("n").alias("n"),
        F.min("conv").alias("conv"),
        F.first("bytes").alias("bytes"),
    )
    merged = stored(merged, "trie_nodes")
    below = merged.where("parent is not null").groupBy(F.col("parent").alias("key"))
    below = below.agg(F.count("*").alias("n_children"), F.count_if(F.col("n") == 1).alias("chains"))
    nodes = merged.join(below, "key", "left").fillna(0, ["n_children", "chains"])
    nodes = stored(nodes, "trie_nodes_and_children")
    several = (F.col("n") > 1) | (F.col("depth") == 0)
    shared = nodes.where(several).select(
        "key",
        "parent",
        "depth",
        (F.col("chains") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"),
        ((F.col("n") - 1) * F.col("bytes")).alias("saved"),
    )
    sums = stored(subtree_sums(stored(shared, "shared_nodes")), "sums_of_shared")
    ends = stored(end_digests(parts), "end_digests")
    # A node of one member continues its parent's chain, unless the parent has several. All else hangs on the root, which
    # would be one key for a third of all rows.
    above = nodes.where((F.col("n") > 1) & (F.col("depth") > 0))
    above = stored(above.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv")), "shared_parents")
    root = nodes.where("depth = 0").select("conv").first()
    parent_conv = F.when(F.col("depth") == 1, F.lit(root.conv if root else None).cast("long"))
    top = nodes.where("depth <= 1").withColumn("parent_conv", parent_conv)
    deep = nodes.where("depth > 1").join(above, "parent", "left")
    deep = deep.withColumn("parent_conv", F.coalesce("parent_conv", "conv"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        top.unionByName(deep)
        .join(sums, "key", "left")
        .join(ends, "key", "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.col("parent_conv").alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            "n_children",
            F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
            F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )


def conversation_trie(rows: DataFrame) -> DataFrame:
    """The trie of ``conv_id, turn, role, text`` as they stand."""
    own = stored(numbered_turns(rows), "turns")
    return prefix_trie(own, own.groupBy("conv").agg(F.max("pos").alias("total")))


def rebuilt(own: DataFrame, family: int = 5, lead: int = 9) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths after each conversation took its first turns from the first of its family.

    Conversation c starts with the first h turns of c - c % ``family``, h = crc32(c) % ``lead``, and goes on with its own
    turns after its first h.
    """
    lengths = own.groupBy("conv").agg(F.max("pos").alias("own"))
    base, h = F.col("conv") - F.col("conv") % family, F.crc32(F.col("conv").cast("string").cast("binary")) % lead
    convs = lengths.withColumns({"base": base, "h": h})
    of_base = lengths.select(F.col("conv").alias("base"), F.col("own").alias("base_own"))
    taken = F.least("h", F.coalesce("base_own", F.lit(0)))
    total = F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = convs.join(of_base, "base", "left").withColumn("taken", taken).withColumn("total", total)
    convs = stored(convs.select("conv", "base", "h", "taken", "total"), "rebuilt_conversations")
    first = own.where(F.col("pos") < lead).withColumnRenamed("conv", "base").join(convs, "base").where(F.col("pos") <= F.col("h"))
    rest = own.join(convs, "conv").where(F.col("pos") > F.col("h"))
    rest = rest.withColumn("pos", F.col("taken") + F.col("pos") - F.col("h"))
    columns = ["conv", "pos", "digest", "bytes"]
    return first.select(columns).unionByName(rest.select(columns)), convs.select("conv", "total")


def op13_conversation_trie(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    own = stored(numbered_turns(rows), "turns")
    return prefix_trie(*rebuilt(own))


#: Prefixes as strings of digests; crc32 bit by bit.
_CRC = """xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(range(1, length(CAST(c AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(c AS VARCHAR), i, 1)) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
      lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS BIGINT)) ELSE x // 2 END)),
  CAST(4294967295 AS BIGINT))"""
OP13_SQL = f"""
WITH digested AS (
  SELECT conv_id AS c, turn, octet_length(encode(coalesce(text, ''))) AS bytes,
         sha256(CAST(octet_length(encode(coalesce(role, ''))) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS d
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, d, bytes, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, d) AS q FROM digested
), lengths AS (
  SELECT c, max(q) AS n, c - c % 5 AS base, {_CRC} % 9 AS h FROM own GROUP BY c
), convs AS (
  SELECT l.c, l.base, l.h, least(l.h, coalesce(b.n, 0)) AS taken FROM lengths l LEFT JOIN lengths b ON b.c = l.base
), turns AS (
  SELECT k.c, o.q AS pos, o.d, o.bytes FROM convs k JOIN own o ON o.c = k.base AND o.q <= k.h
  UNION ALL
  SELECT k.c, k.taken + o.q - k.h, o.d, o.bytes FROM convs k JOIN own o ON o.c = k.c AND o.q > k.h
), paths AS (
  SELECT c, pos, bytes, string_agg(d, '') OVER (PARTITION BY c ORDER BY pos) AS path FROM turns
  UNION ALL
  SELECT c, 0, 0, '' FROM convs
), nodes AS (
  SELECT path, CAST(pos AS BIGINT) AS depth, min(c) AS conv, count(*) AS n, max(bytes) AS bytes,
         substr(path, 1, 64 * (CAST(pos AS INT) - 1)) AS parent
  FROM paths GROUP BY path, pos
), ended AS (
  SELECT path, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends
  FROM (SELECT c, arg_max(path, pos) AS path FROM paths GROUP BY c) GROUP BY path
), children AS (
  SELECT parent AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent
), sums AS (
  SELECT p.path, sum((u.n - 1) * u.bytes) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM nodes u LEFT JOIN children k ON k.path = u.path JOIN paths p ON p.c = u.conv AND p.pos <= u.depth
  GROUP BY p.path
)
SELECT v.conv AS conv_id, v.depth, p.conv AS parent_conv_id, v.n AS n_convs, coalesce(k.n, 0) AS n_children,
       s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM nodes v
LEFT JOIN nodes p ON v.depth > 0 AND p.path = v.parent
LEFT JOIN children k ON k.path = v.path
LEFT JOIN ended e ON e.path = v.path
JOIN sums s ON s.path = v.path
"""
