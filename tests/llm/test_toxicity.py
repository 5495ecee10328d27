import math
import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from termfold.llm import toxicity
from termfold.llm.arrays import slices

SF_DIR = "/root/testdata/sf0.01"


def made():
    draw = random.Random(6)
    usual = [a + b for a in ("ver", "mon", "tal", "rig", "sop", "len") for b in ("ade", "ion", "ur", "est", "al", "o")]
    bad = ["ugliest", "vileness", "awfulword"]
    docs, labels = [], []
    for i in range(400):
        words = [draw.choice(usual) for _ in range(draw.randrange(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(draw.randrange(1, 4)):
                words.insert(draw.randrange(len(words)), draw.choice(bad).capitalize() + draw.choice(("", ",", "!")))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs += [(500, None), (501, ""), (None, "ugliest"), (3, docs[3][1]), (502, "ÄÖ 漢字 🙂"), (503, "ver " * 30_000 + "ugliest")]
    return docs, labels + [(500, 1), (501, 0), (502, None), (3, 0), (None, 1)]


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = made()
    docs = spark.createDataFrame([(*d, "old", 2) for d in docs], "doc_id long, text string, score string, evidence int")
    return docs.repartition(3), spark.createDataFrame([(*x, "l") for x in labels], "doc_id long, toxic int, text string")


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(*tables)


def words(text):
    """Runs of ASCII letters and characters outside ASCII, ASCII and Latin-1 capitals folded."""
    fold = {c: c + 32 for c in (*range(65, 91), *range(0xC0, 0xDF))}
    return re.findall(r"[A-Za-z\u0080-\U0010ffff]+", (text or "").translate(fold))


def plain_scores(docs, labels):
    """Cosines of every document with every example, votes of the nearest: as the docstring says, by itself."""
    label = {}
    for i, toxic in labels:
        if i is not None and toxic is not None:
            label[i] = max(label.get(i, 0), toxic)
    examples = [(i, label[i], Counter(words(t))) for i, t in docs if i in label]
    n = Counter(t > 0 for _, t, _ in examples)
    df = Counter(w for _, t in docs for w in set(words(t)))
    of = {kind: Counter(w for _, t, c in examples if (t > 0) == kind for w in c) for kind in (False, True)}
    known = set(of[False]) | set(of[True])

    def vector(counts):
        v = {}
        for w, c in counts.items():
            if w in known:
                rate = (max(0, of[True][w] - 1) / n[True]) / (max(1, of[False][w]) / n[False])
                v[w] = (1 + math.log(c)) * math.log((1 + len(docs)) / (1 + df[w])) * math.log2(2 + rate) ** 2
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()} if norm else {}

    vectors = [(i, t, vector(c)) for i, t, c in examples]
    return [sorted((-round(sum(x * e.get(w, 0) for w, x in v.items()), 9), t > 0, i) for i, t, e in vectors) for v in (vector(Counter(words(t))) for _, t in docs)]


def test_cosines_equal_those_of_all_examples(tables, model):
    """The index finds the k nearest: same cosines as comparing with every example."""
    docs, labels = made()
    expected = plain_scores(docs, labels)
    arrays = pa.array([t for _, t in docs])
    for start, end, data, offsets in slices(arrays):
        row, term, count = model.terms.counts(data, offsets)
        entries, cosines = model.nearest(row, term, count, end - start)
        for text in range(start, end):
            # An entry stands for all examples with its vector.
            distinct = sorted({-c for c, _, _ in expected[text] if c < 0}, reverse=True)
            found = sorted({round(c, 9) for c in cosines[text - start] if c > 0}, reverse=True)
            assert found == pytest.approx(distinct[: len(found)], abs=1e-6)
            assert len(found) == len(distinct) or np.count_nonzero(cosines[text - start]) == toxicity.NEIGHBOURS


def test_few_blocks_are_scored_where_bounds_are_tight(model, monkeypatch):
    monkeypatch.setattr(toxicity, "COMMON", 1.1)
    monkeypatch.setattr(model, "_common", None)
    assert len(model.ids) > 4 * toxicity.BLOCK
    read = []
    runs = toxicity._runs
    monkeypatch.setattr(toxicity, "_runs", lambda a, b: read.append(int((b - a).sum())) or runs(a, b))
    for _, _, data, offsets in slices(pa.array(["ugliest ugliest ugliest verade monion talur"])):
        model.nearest(*model.terms.counts(data, offsets), 1)
    postings = sum(model.block_start[model.term_start[t + 1]] - model.block_start[model.term_start[t]] for t in model.terms.counts(data, offsets)[1])
    assert sum(read[2:]) < postings
    model._common = None


def test_sizes_of_blocks_and_groups_change_nothing(tables, model, monkeypatch):
    def cosines(of):
        return [of.nearest(*of.terms.counts(d, o), len(o) - 1)[1] for _, _, d, o in slices(pa.array([t for _, t in made()[0]]))]

    expected = cosines(model)
    for name, size in (("BLOCK", 5), ("TOGETHER", 7), ("CHUNK", 11), ("COMMON", 0.3)):
        monkeypatch.setattr(toxicity, name, size)
    assert all(np.allclose(a, b) for a, b in zip(expected, cosines(toxicity.fit(*tables))))


def test_scores_of_odd_rows(tables, model):
    docs, _ = tables
    found = toxicity.score(docs, model)
    assert found.columns == ["doc_id", "text", "score", "evidence"]
    rows = found.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_text = {r.text: r.score for r in rows}
    assert by_text[None] == by_text[""] == by_text["ÄÖ 漢字 🙂"] < 0.3 < 0.7 <= by_text["ugliest"]
    wrong = [r for r in rows if r.doc_id is not None and r.doc_id < 400 and (r.score >= 0.7) != (r.doc_id % 4 == 0)]
    assert len(wrong) < 10
    assert all(i % 4 == 0 for r in rows if r.text == "ugliest" for i in r.evidence[:1])
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_labels_missing(tables):
    docs, labels = tables
    for some, expected in ((labels.limit(0), 0.0), (labels.where("toxic = 1"), 1.0), (labels.where("toxic = 0"), 0.0)):
        found = {round(r.score, 6) for r in toxicity.score(docs, toxicity.fit(docs, some)).select("score").distinct().collect()}
        assert found == {expected}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_held_out(spark):
    found = toxicity.op7_toxicity(spark, SF_DIR).where("held_out")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic is not null").select("doc_id", "toxic")
    both = found.join(labels, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("share")).collect()
    share = {r.toxic: r.share for r in both}
    assert share[1] > 0.6 and share[0] < 0.05
