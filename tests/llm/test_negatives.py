import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from termfold.llm import negatives
from termfold.llm.topk import scaled

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score string, query string, slot string"


def run(spark, rows, every=3, **sizes):
    df = spark.createDataFrame([(*row, "r", "s", "q", "t") for row in rows], SCHEMA).repartition(3)
    whole = df.select(F.col("vec_id").alias("id"), "label", scaled(F.col("embedding")).alias("vector"), "rank", "score", "query", "slot")
    return sorted(tuple(r) for r in negatives.mine(whole, whole.where(F.col("id") % every == 0), **sizes).collect())


def plain(rows, every=3, positives=5, negatives=3, low=50, high=95):
    taken = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    anchors = {}
    for i, label, v in taken:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in anchors.items():
        scores = [(-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(v, w)))), j, m == label) for j, m, w in taken if j != a]
        for p, j, _ in sorted(s for s in scores if s[2])[:positives]:
            fits = sorted(s for s in scores if not s[2] and low * -p <= 100 * -s[0] <= high * -p)
            out += [(a, j, rank, n, -p, -s) for rank, (s, n, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def test_against_all_pairs_with_ties_and_odd_rows(spark):
    draw = random.Random(1)
    rows = [(i, [draw.choice((-0.5, -0.25, 0.0, 0.25, 0.5, 0.75)) for _ in range(5)], draw.randrange(3)) for i in range(240)]
    rows += [(300, None, 1), (303, [None, 1.0], 1), (306, [math.nan], 1), (309, [math.inf], 2), (None, [1.0], 1), (312, [1.0, 1.0], None)]
    rows += [(315, [], 1), (318, [0.5, 0.5], 1), (9, [0.5] * 5, 0), (318, [0.25] * 9, 0), (321, [3e30, -3e30, 1.0, 0.0], 2)]
    # Equal rows under one id are told apart by nothing: only one of each here.
    assert run(spark, rows) == plain(rows)


def test_many_blocks_slabs_and_batches(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 40)
    monkeypatch.setattr(negatives, "SEED_BLOCKS", 1)
    monkeypatch.setattr(negatives, "SLICE", 7)
    monkeypatch.setattr(negatives, "BATCH_BYTES", 30_000)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 24))
    rows = [(i, [float(x) for x in centres[i % 6] + 0.4 * rng.normal(size=24)], int(rng.integers(4))) for i in range(500)]
    assert run(spark, rows, every=5) == plain([(i, list(np.float32(v).astype(float)), label) for i, v, label in rows], every=5)


def test_other_sizes(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)], i % 2) for i in range(90)]
    assert run(spark, rows, positives=2, negatives=7, low=0, high=100) == plain(rows, positives=2, negatives=7, low=0, high=100)


def test_empty_and_lonely(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0], 1)]) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    rows = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.75], 2), (4, [0.75], 3)]
    assert run(spark, rows) == plain(rows) != []


@pytest.mark.parametrize("least", [-np.inf, 0.0, 40_000.0, 1e9])
def test_threshold_join_finds_all_and_skips(least):
    rng = np.random.default_rng(4)

    def some(n):
        vectors = np.floor(256 * rng.normal(size=(n, 32)) * np.linspace(1, 0.05, 32))
        return negatives.Rows(np.arange(n), np.zeros(n, np.int64), vectors, negatives._suffix_norms(vectors))

    asked, block = some(9), some(300)
    left, right, scores = negatives.threshold_join(asked, block, np.full(9, least))
    every = (asked.vectors @ block.vectors.T).astype(np.int64)
    want = {(i, j): every[i, j] for i, j in zip(*np.nonzero(every >= least))}
    assert dict(zip(zip(left.tolist(), right.tolist()), scores)) == want


def test_covered_dimensions_are_not_indexed(monkeypatch):
    """High thresholds touch few slabs of few rows, and score few pairs in full."""
    rng = np.random.default_rng(5)
    vectors = np.floor(256 * rng.normal(size=(400, 64)) * np.geomspace(1, 0.01, 64))
    rows = negatives.Rows(np.arange(400), np.zeros(400, np.int64), vectors, negatives._suffix_norms(vectors))
    asked = rows.take(np.arange(8))
    full = []
    scores = negatives._scores
    monkeypatch.setattr(negatives, "_scores", lambda a, b: full.append(len(a)) or scores(a, b))
    least = 0.8 * asked.norms[:, 0] ** 2
    negatives.threshold_join(asked, rows, least)
    reach = (least / asked.norms[:, 0]).min()
    indexed = (rows.norms[:, :-1] >= reach).sum(1)
    assert indexed.mean() < 0.5 * 8
    assert sum(full) < 0.1 * 8 * 400
