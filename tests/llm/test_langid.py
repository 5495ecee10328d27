import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import plain
from termfold.llm import langid

WORDS = {"en": "the and with that thing of to was".split(), "de": "der die und nicht schön über zu ein".split(), "fr": "le la été une où dans pas qué".split()}


def rows():
    draw = random.Random(2)
    made = []
    for i in range(90):
        lang = draw.choice(sorted(WORDS))
        made.append((i, " ".join(draw.choice(WORDS[lang]) for _ in range(draw.randrange(1, 40))).capitalize(), lang))
    made += [(90, None, "en"), (91, "", "de"), (92, "123 !!", "fr"), (93, "the", None), (None, "und die", "de"), (3, "la la", "fr"), (3, "la la", "fr")]
    return made + [(94, "THE ÉTÉ\n\nİ ß ﬁ 漢字 " * 3000, "en"), (95, "x", "odd\tname"), (96, "🙂", None)]


def test_against_a_plain_version(spark):
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows()], "doc_id long, text string, lang string, lang_pred string, score int").repartition(3)
    learn = docs.where(~langid.held_out(F.col("doc_id")))
    learned = langid.learn_profiles(learn, 40)
    expected = plain.profiles([(t, g) for i, t, g in rows() if not plain.held_out(i)], 40)
    assert {g: len(p) for g, p in learned.items()} == {g: len(p) for g, p in expected.items()}
    found = langid.identify(docs, learned, 40)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    found = sorted((r.doc_id or -1, r.text or "", r.lang_pred, round(r.score, 9)) for r in found.collect())
    wanted = [(i or (-1 if i is None else 0) or -1, t or "", *plain.nearest(t, expected, 40)) for i, t, _ in rows()]
    assert found == sorted((i, t, g, round(s, 9)) for i, t, g, s in wanted)


def test_nothing_learned_and_empty_table(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    assert langid.learn_profiles(docs.limit(0)) == {}
    found = langid.identify(docs, {}).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in found] == [("und", 0.0)]
    assert langid.identify(docs.limit(0), {"en": [1]}).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_held_out_accuracy(spark):
    found = langid.op9_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = found.where("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_a_batch_is_counted_in_slices():
    import tracemalloc

    import pyarrow as pa

    draw = np.random.default_rng(1)
    texts = ["".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz "), 4000)) for _ in range(1500)]
    batch = pa.record_batch([pa.array(texts), pa.array(["en"] * len(texts))], ["text", "lang"])
    list(langid._count_task(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    out = list(langid._count_task(iter([batch.slice(0, 0), batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    keys, counts = np.unique(np.concatenate([langid.ngrams(t) for t in texts]), return_counts=True)
    found = {}
    for rows in out:
        for key, n in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist()):
            found[key] = found.get(key, 0) + n
    assert found == dict(zip(keys.tolist(), counts.tolist()))
    assert peak < 150e6, peak
