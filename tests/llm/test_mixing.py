import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import plain
from termfold.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, tokens string, Kept int"


def made():
    draw = random.Random(4)
    docs = []
    for i in range(200):
        words = " ".join("word" for _ in range(draw.randrange(1, 60)))
        text = draw.choice((words, words, words + " | " * 4, words + " License", words + "!!" * 3))
        docs.append((i, text, draw.choice(("en", "en", "en", "de", None)), draw.choice(("hot", "hot", "hot", "a", "b", None))))
    docs += [(300, None, "en", "hot"), (301, "", "xx", "hot"), (None, "null id", "en", "a"), (5, docs[5][1], *docs[5][2:]), (302, "w " * 30_000, "en", "b")]
    return docs


def cells_of(rows):
    cells = Counter()
    for r in rows:
        cells[r.source, r.lang, r.topic] += r.tokens
    return dict(cells)


def check(rows, targets, keep):
    cells = cells_of(rows)
    weight = plain.rake(cells, targets)
    chance = plain.probabilities(cells, weight, keep)
    for r in rows:
        cell = (r.source, r.lang, r.topic)
        assert r.weight == pytest.approx(weight[cell], abs=1e-5)
        assert r.probability == pytest.approx(chance[cell], abs=1e-4)


def test_against_a_plain_fit(spark):
    docs = spark.createDataFrame([(*d, "old", 7) for d in made()], SCHEMA).repartition(3)
    found = mixing.mix(docs)
    assert found.columns == ["doc_id", "text", "lang", "source", "topic", "tokens", "weight", "probability", "kept"]
    rows = found.collect()
    assert len(rows) == len(made())
    for r in rows:
        assert r.tokens == len((r.text or "").encode().split())
    cells = cells_of(rows)
    check(rows, [plain.evened(cells, place, mixing.TEMPERATURE) for place in range(3)], mixing.KEEP)
    drawn = {(r.doc_id, r.text): r.kept for r in rows}
    again = {(r.doc_id, r.text): r.kept for r in mixing.mix(docs.repartition(5)).collect()}
    assert drawn == again and 0 < sum(drawn.values()) < len(drawn)


def test_given_targets(spark):
    docs = spark.createDataFrame([(*d, "old", 7) for d in made()], SCHEMA)
    targets = {"source": {"hot": 1, "a": 2, "b": 1, "absent": 5}, "lang": {"en": 3, "de": 1}}
    rows = mixing.mix(docs, targets, keep=0.2).collect()
    cells = cells_of(rows)
    sources = {"hot": 0.25, "a": 0.5, "b": 0.25}
    check(rows, [sources, {"en": 0.75, "de": 0.25}, plain.evened(cells, 2, mixing.TEMPERATURE)], 0.2)
    assert all(r.probability == 0 for r in rows if r.source is None and r.tokens)


def test_no_tokens_and_no_rows(spark):
    empty = spark.createDataFrame([(1, None, "en", "a", "", 0), (2, "", None, None, "", 0)], SCHEMA)
    assert [r.probability for r in mixing.mix(empty, keep=0.3).collect()] == [0.3, 0.3]
    assert mixing.mix(empty.limit(0)).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(empty, {"source": {}}).collect()


def test_draws_are_even(spark):
    rows = spark.range(20_000).select(mixing.draw(F.col("id"), F.lit("t")).alias("u"))
    low, mean, high = rows.agg(F.min("u"), F.avg("u"), F.max("u")).first()
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.01
