import random

import pytest

import plain
from termfold.llm import lines


def made(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["é", "ß漢"]
    known = [[draw.choice(vocabulary) for _ in range(draw.choice((1, 3, 8, 9, 15, 16, 17, 40)))] for _ in range(12)]

    def line():
        if draw.random() < 0.1:
            return draw.choice(["", "   ", "\t"])
        words = list(draw.choice(known))
        for _ in range(draw.choice((0, 0, 1, 1, 2))):
            at, kind = draw.randrange(len(words)), draw.random()
            if kind < 0.4:
                words[at] = draw.choice(vocabulary)
            elif kind < 0.7:
                words.insert(at, draw.choice(vocabulary))
            elif len(words) > 1:
                del words[at]
        return draw.choice((" ", "  ")).join(words)

    docs = [(i, "\n".join(line() for _ in range(draw.randrange(1, 6)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "\n\n"), (None, docs[5][1]), (7, docs[7][1]), (8, "a new line of eight words for one id\n" + docs[9][1])]
    return docs + [(103, "x y z " * 3000 + "\n" + "x y z " * 3000 + "q"), (104, "p p p p p p p p p\np p p p p p p p")]


@pytest.mark.parametrize("copy_share", [None, 0.5, 0.8])
def test_against_all_pairs_of_lines(spark, copy_share):
    docs = made(1)
    if copy_share:
        # Copies, one with an edited line, one with lines of two documents, one that repeats itself.
        whole = [f"{c} line of more than eight words for the copy {c} here" for c in "abcdef"]
        docs += [(200, "\n".join(whole)), (201, "\n".join(whole)), (202, "\n".join([*whole[:5], "another line altogether, of eight words or more, here"]))]
        docs += [(203, "\n".join([*whole[:3], *docs[2][1].split("\n")])), (204, "\n".join([whole[0]] * 4)), (205, whole[1] + "\n" + "new words " * 30)]
    table = spark.createDataFrame([(*d, "a", 3) for d in docs], "doc_id long, text string, line string, N_removed int").repartition(3)
    found = lines.dedup_lines(table, copy_share=copy_share)
    assert found.columns == ["doc_id", "text", "line", "n_lines", "n_removed"]
    key = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or "")
    rows = found.collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=key) == sorted(zip([d for d, _ in docs], plain.dedup_lines(docs, lines.NEAR_WORDS, copy_share)), key=key)
    for r in rows:
        assert r.text is None or r.n_lines - r.n_removed in (r.text.count("\n") + 1, 0)


def test_empty_table(spark):
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_one_word_apart():
    draw = random.Random(0)
    for _ in range(3000):
        a, b = ([draw.choice("xyz") for _ in range(draw.randrange(0, 7))] for _ in range(2))
        assert lines.one_word_apart(a, b) == (plain.word_distance(a, b) <= 1)
