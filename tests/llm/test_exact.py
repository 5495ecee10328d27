import hashlib
import random
from collections import defaultdict

import pytest

from termfold.llm import exact

SCHEMA = "doc_id long, text string, keep_id string, leader string, n int, group_size string"


def run(spark, rows, owner="largest", parts=3):
    df = spark.createDataFrame([(*row, "k", "l", 1, "g") for row in rows], SCHEMA).repartition(parts)
    found = exact.owners(df, owner=owner).collect()
    return sorted(((r.id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found), key=repr)


def plain(rows, owner="largest"):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max(known) if owner == "largest" else min(known)) if known else None
        first = True
        for i in ids:
            out.append((i, keep, len(ids), first and i == keep, hashlib.sha256(text.encode()).hexdigest()))
            first = first and i != keep
    return sorted(out, key=repr)


def texts(draw, n):
    stems = ["", "a", "ab", "abc", "b" * 3000, "b" * 2999 + "c", "ü" * 40, "ü" * 39 + "é", "line\nline", " ", "a ", "A"]
    return [draw.choice(stems) + draw.choice(["", "", "x", "y" * 700]) for _ in range(n)]


@pytest.mark.parametrize("owner", ["largest", "smallest"])
def test_against_grouping(spark, owner):
    draw = random.Random(3)
    rows = list(enumerate(texts(draw, 400)))
    rows += [(500, None), (501, None), (None, None), (None, "only null"), (None, "only null"), (7, rows[7][1]), (7, rows[7][1]), (7, "other")]
    assert run(spark, rows, owner) == plain(rows, owner)


def test_subtrees_written_out_early_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(exact, "HELD_BYTES", 5000)
    draw = random.Random(4)
    rows = list(enumerate(texts(draw, 300)))
    assert run(spark, rows) == plain(rows)


def test_one_hash_for_all_texts(spark, monkeypatch):
    """Equality is decided by the bytes, not by the hash."""
    from pyspark.sql import functions as F

    keys = exact.text_keys
    monkeypatch.setattr(exact, "text_keys", lambda text: (keys(text)[0], F.lit(1).cast("long"), F.lit(2).cast("long")))
    rows = list(enumerate(texts(random.Random(5), 200)))
    assert run(spark, rows, parts=5) == plain(rows)


def test_empty_table_and_single_group(spark):
    assert run(spark, []) == []
    rows = [(i, "the same") for i in range(90)]
    assert run(spark, rows, parts=8) == plain(rows)


def test_dedup_keeps_columns_and_one_row_of_each_text(spark):
    rows = [(1, "x", "a"), (2, "x", "b"), (3, "y", "c"), (3, "y", "d"), (None, None, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    found = sorted(((r.doc_id, r.text, r.group_size) for r in exact.dedup(df).collect()), key=repr)
    assert found == [(2, "x", 2), (3, "y", 2), (None, None, 1)]
    assert exact.dedup(df).columns == ["doc_id", "text", "kept", "group_size"]


def test_unknown_owner(spark):
    with pytest.raises(ValueError):
        exact.owners(spark.createDataFrame([(1, "x")], "doc_id long, text string"), owner="first")


def test_trie_holds_what_was_put(spark):
    draw = random.Random(6)
    strings = ["".join(draw.choice("ab") for _ in range(draw.randrange(0, 400))).encode() for _ in range(600)]
    strings += [s + b"z" * 1000 for s in strings[:50]] + strings[:100]
    trie, want, grown = exact.Trie(), defaultdict(list), 0
    for i, s in enumerate(strings):
        grown += trie.insert(s, i)
        want[s].append(i)
    assert trie.root.held == grown == sum(map(held, trie.root.children.values()))
    size, first = trie.largest()
    part = dict(trie.take(first))
    assert part == {s: r for s, r in want.items() if s[:1] == bytes([first])}
    assert trie.root.held == grown - size
    assert part | dict(trie.take()) == want


def held(node):
    return len(node.label) + sum(map(held, node.children.values()))
