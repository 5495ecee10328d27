import math
import random

import pytest
from pyspark.sql import functions as F

from termfold.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, rank string, query_id string"


def run(spark, rows, every=3, k=5):
    df = spark.createDataFrame([(*row, "s", "r", "q") for row in rows], SCHEMA).repartition(2)
    whole = df.select(F.col("vec_id").alias("id"), topk.scaled(F.col("embedding")).alias("vector"))
    found = topk.search(topk.build_blocks(whole, "id"), whole.where(F.col("id") % every == 0), k)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())


def plain(rows, every=3, k=5):
    taken = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            taken.setdefault(i, []).append([math.floor(256 * x) for x in v])
    out = []
    for i, vectors in taken.items():
        if i % every == 0:
            query = min(vectors)
            scores = [
                (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(query, v)))), j)
                for j, vs in taken.items() if j != i for v in vs
            ]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_against_all_pairs_with_ties_and_odd_rows(spark):
    draw = random.Random(1)
    rows = [(i, [draw.choice((-0.5, -0.25, 0.0, 0.25, 0.5)) for _ in range(4)]) for i in range(300)]
    rows += [(300, None), (301, [None, 1.0]), (302, [math.nan, 1.0]), (303, [math.inf]), (None, [1.0])]
    rows += [(306, []), (309, [0.5, 0.5]), (9, [0.5] * 4), (9, [0.5] * 4), (10, [0.25] * 4), (315, [3e30, -3e30, 1.0, 0.0])]
    assert run(spark, rows) == plain(rows)


def test_fewer_rows_than_asked_and_empty_tables(spark):
    rows = [(0, [1.0]), (1, [2.0]), (3, [3.0])]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []


def test_blocks_are_skipped(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(0)
    centres = rng.normal(size=(32, 8)) * 100
    blocks = []
    for b in range(32):
        vectors = np.round(centres[b] + rng.normal(size=(64, 8)))
        blocks.append({"ids": np.arange(b * 64, b * 64 + 64), "vectors": vectors, "largest": vectors.max(0), "smallest": vectors.min(0), "dims": 8})
    scored = []
    products = topk._products
    monkeypatch.setattr(topk, "_products", lambda q, v: scored.append(len(q)) or products(q, v))
    best = topk._Best(4, 5)
    ids, queries = np.arange(4), np.concatenate([b["vectors"] for b in blocks])[:4]
    topk._search_blocks(blocks, ids, queries, best, ids)
    every = np.concatenate([b["vectors"] for b in blocks])
    scores = (queries @ every.T).astype(int)
    scores[ids, ids] = -(10**9)
    assert np.array_equal(best.scores, -np.sort(-scores, axis=1)[:, :5])
    assert sum(scored) < 4 * 32 / 2


@pytest.mark.parametrize("k", [1, 7])
def test_other_k(spark, k):
    rows = [(i, [math.sin(i), math.cos(3 * i)]) for i in range(90)]
    assert run(spark, rows, k=k) == plain(rows, k=k)
