import random

import plain
from termfold.llm import jaccard
from termfold.llm.components import components


def made(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passages = [[draw.choice(words) for _ in range(30)] for _ in range(4)]
    docs, base = [], []
    for i in range(120):
        if base and draw.random() < 0.5:
            text = list(draw.choice(base))
            for _ in range(draw.choice((0, 1, 1, 2, 3, 6))):
                text[draw.randrange(len(text))] = draw.choice(words)
        else:
            text = [draw.choice(words) for _ in range(draw.choice((3, 5, 7, 40, 80, 150)))]
            if draw.random() < 0.5:
                text += draw.choice(passages)
            base.append(text)
        docs.append((i if seed == 1 else i * 3 % 120, draw.choice((" ", "\n", "\t ")).join(w.upper() if draw.random() < 0.1 else w for w in text)))
    docs += [(200, None), (201, ""), (202, " \n"), (203, "one two"), (204, "ONE  two"), (205, "two one"), (206, "É é x y z q"), (207, "é é x y z q")]
    # Repeated rows, and ids with two texts that tie two groups together.
    return docs + [docs[0], (None, docs[1][1]), (300, docs[2][1]), (300, docs[50][1]), (301, "a " * 20_000), (302, "a a a a a")]


def test_against_all_pairs(spark):
    for seed in (1, 2):
        docs = made(seed)
        table = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, node int, component int").repartition(3)
        found = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(table).collect()]
        key = lambda x: tuple((v is not None, v or 0) for v in x)
        assert sorted(found, key=key) == sorted(plain.near_duplicates(docs), key=key)


def test_empty_table(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)}


def test_prefixes_grow_with_crowded_shingles():
    import numpy as np

    assert jaccard.prefix_length(100, np.zeros(100)) == 21
    assert jaccard.prefix_length(100, np.full(100, 50.0)) > 21
    assert jaccard.prefix_length(1, np.full(1, 50.0)) == 1
