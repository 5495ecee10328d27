import hashlib
import random

import numpy as np

from termfold.llm import fingerprints


def prose(draw, n):
    return " ".join("".join(draw.choice("etaoinshr") for _ in range(draw.randrange(1, 9))) for _ in range(n))


def test_equal_substrings_share_names_inside():
    draw = random.Random(1)
    shared = prose(draw, 600)
    names = []
    for lead in (prose(draw, 100), "x" + prose(draw, 37)):
        points = np.frombuffer((lead + " " + shared).encode("utf-32-le"), np.uint32)
        symbols, texts = fingerprints.mixed(points.astype(np.uint64) + np.uint64(1)), np.zeros(len(points), np.int64)
        for level in range(1, 5):
            symbols, texts = fingerprints._phrases(symbols, texts, level)
            if level >= 2:
                names.append(symbols)
    for a, b in zip(names[:3], names[3:]):
        same = 0
        while same < min(len(a), len(b)) and a[-1 - same] == b[-1 - same]:
            same += 1
        assert same > 0.7 * len(b) * len(shared) / (len(shared) + 600) and same > 4


def test_phrases_are_short_and_cover_the_text():
    draw = np.random.default_rng(0)
    for size in (1, 2, 3, 50, 5000):
        symbols = fingerprints.mixed(draw.integers(0, 3, size).astype(np.uint64))
        collapsed, _ = fingerprints._without_runs(symbols, np.zeros(size, np.int64))
        names, texts = fingerprints._phrases(symbols, np.zeros(size, np.int64), 1)
        assert 1 <= len(names) <= max(1, len(collapsed) // 2) and len(names) >= len(collapsed) / 14


def test_texts_do_not_touch_each_other():
    draw = random.Random(2)
    texts = [prose(draw, n) for n in (1, 40, 3, 200, 1)] + ["", "a", "aa", "aaaa" * 500, "é🙂漢"]
    together = fingerprints.text_sketches(texts)
    for text, sketch in zip(texts, together):
        assert np.array_equal(fingerprints.text_sketches([text])[0], sketch)


def test_likeness_follows_what_is_shared():
    draw = random.Random(3)
    text, other = prose(draw, 2000), prose(draw, 2000)
    values = []
    for share in (0, 0.25, 0.5, 0.75, 1):
        cut = int(len(text) * share)
        both = fingerprints.text_sketches([text, text[:cut] + other[cut:]])
        values.append(float(fingerprints.likeness(both[:1], both[1:])[0]))
    assert values == sorted(values) and values[0] < 0.05 and values[-1] == 1
    assert abs(values[2] - 1 / 3) < 0.15


def run(spark, rows, partitions=3):
    docs = spark.createDataFrame([(*row, "x", 0.5) for row in rows], "doc_id long, text string, fingerprint string, part double")
    return fingerprints.with_next_document(docs.repartition(partitions)).collect()


def test_ring_of_odd_rows(spark):
    draw = random.Random(4)
    rows = [(i, prose(draw, draw.randrange(0, 80))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a" * 100_000), (103, "🙂" * 10), (104, rows[3][1])]
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    found = {r.doc_id: r for r in run(spark, rows)}
    assert len(found) == len(rows)
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        changed = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        three = fingerprints.text_sketches([text, changed, following])
        r = found[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == tuple(map(fingerprints.written, three[:2]))
        assert r.near_edited == fingerprints.likeness(three[:1], three[1:2])[0]
        assert r.near_next == fingerprints.likeness(three[:1], three[2:])[0]
    assert found[104].fingerprint == found[3].fingerprint


def test_one_row_repeated_rows_null_ids_and_no_rows(spark):
    assert run(spark, []) == []
    one, = run(spark, [(1, "some text here")])
    assert one.near_next == 1.0
    rows = run(spark, [(1, "some text here")] * 2 + [(None, "other words here"), (None, None)])
    assert len(rows) == 4 and len({r.edited_sha256 for r in rows if r.doc_id == 1}) <= 2
