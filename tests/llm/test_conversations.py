import hashlib
import random
from collections import defaultdict
from zlib import crc32

import pytest

from termfold.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key string, shard string"


def run(spark, rows, trie=lambda df: conversations.prefix_trie(*conversations.rebuilt(conversations.numbered_turns(df)))):
    df = spark.createDataFrame([(*row, "d", "k", "s") for row in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in trie(df).collect()), key=repr)


def numbered(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, digest, (role, text)))
    return {conv: [t[3] for t in sorted(turns)] for conv, turns in own.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def plain(convs):
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, inside in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(inside) - 1) * len(path[-1][1].encode()) if path else 0
    out = []
    for path, inside in nodes.items():
        ends = ",".join(str(c) for c in sorted(inside) if len(convs[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((
            min(inside), len(path), parent, len(inside), children.get(path, 0), leaves[path], saved[path],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def some_rows(draw, convs=120, longest=12):
    lines = ["hello", "hällo", "", "a longer line of text", None]
    rows = []
    for c in range(convs):
        for turn in range(draw.randrange(0, longest)):
            rows.append((c, turn, draw.choice(["user", "assistant", None]) if turn > 2 else "user", draw.choice(lines if turn > 1 else lines[:2])))
    return rows


def test_against_a_plain_trie(spark):
    rows = some_rows(random.Random(1))
    rows += [(None, 1, "user", "x"), (700, None, "user", "first"), (700, 3, "user", "x"), (700, 3, "user", "x"), (-8, 1, "user", "hello")]
    assert run(spark, rows) == plain(rebuilt({c: t for c, t in numbered(rows).items()}))


def test_many_shards_and_windows(spark, monkeypatch):
    monkeypatch.setattr(conversations, "SHARD", 7)
    monkeypatch.setattr(conversations, "WINDOW", 3)
    rows = some_rows(random.Random(2), convs=60, longest=15)
    long = [(200 + i, t, "user", "same" if t < 20 + i else f"own {i}") for i in range(4) for t in range(31)]
    copies = [(300 + i, t, "user", f"copy {t}") for i in range(20) for t in range(11)]
    rows += long + copies
    own = numbered(rows)
    assert run(spark, rows) == plain(rebuilt(own))
    assert run(spark, rows, conversations.conversation_trie) == plain(own)


def test_empty_and_single(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []
    rows = [(3, 1, "user", "x")]
    assert run(spark, rows) == plain(rebuilt(numbered(rows)))


@pytest.mark.parametrize("bits", [0, 1, 0b1011 << 70])
def test_members(bits):
    assert sum(1 << o for o in conversations.members(bits)) == bits
