import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import duckdb_oracle
from termfold import values as v
from termfold.functions import stemming
from termfold.functions.porter import PorterStemmer
from termfold.operators.documents import (
    drop_stop_words, field_documents, stem_documents, stemmed_documents, tokenize_documents,
)

# Examples printed in the paper: word and stem after all steps.
PAPER = """
caresses caress  ponies poni  caress caress  cats cat  feed feed  agreed agre  plastered plaster
bled bled  motoring motor  sing sing  conflated conflat  troubled troubl  sized size  hopping hop
tanned tan  falling fall  hissing hiss  fizzed fizz  failing fail  filing file  happy happi  sky sky
relational relat  conditional condit  rational ration  digitizer digit  operator oper
feudalism feudal  decisiveness decis  hopefulness hope  callousness callous  triplicate triplic
formative form  formalize formal  electrical electr  hopeful hope  goodness good  revival reviv
allowance allow  inference infer  airliner airlin  adjustable adjust  defensible defens
irritant irrit  replacement replac  adjustment adjust  dependent depend  adoption adopt
communism commun  activate activ  effective effect  bowdlerize bowdler  probate probat  rate rate
cease ceas  controll control  roll roll  generalizations gener  oscillators oscil
""".split()

EXTENDED = {
    "dies": "die", "flies": "fli", "died": "die", "spied": "spi", "skies": "sky", "dying": "die",
    "enjoy": "enjoy", "by": "by", "is": "is", "news": "news", "happily": "happili", "fully": "fulli",
    "geology": "geolog", "succeed": "succeed", "cheerfully": "cheer", "possibly": "possibl", "owing": "owe",
}


@pytest.mark.parametrize("word, stem", list(zip(PAPER[::2], PAPER[1::2])))
def test_paper_examples(word, stem):
    assert PorterStemmer("paper").stem(word) == stem


@pytest.mark.parametrize("word", EXTENDED)
def test_extended_examples(word):
    sql = "WITH t AS (SELECT '" + word + "' AS Word), " + ",".join(duckdb_oracle.stems("t"))
    by_patterns = duckdb.sql(sql + " SELECT Stem FROM stems").fetchall()[0][0]
    assert PorterStemmer().stem(word) == by_patterns
    if word not in ("cheerfully", "happily", "fully", "possibly"):
        assert by_patterns == EXTENDED[word]


def test_unknown_mode_is_refused():
    with pytest.raises(ValueError):
        PorterStemmer("other")


def test_lists_keep_order_repetitions_and_nulls(spark):
    rows = [(["running", "cats", "running"],), ([],), (None,), (["", "a"],)]
    df = spark.createDataFrame(rows, "words array<string>").coalesce(1)
    stems = [row[0] for row in df.select(stemming.stem_words(F.col("words"))).collect()]
    assert stems == [["run", "cat", "run"], [], [], ["a"]]


def test_dropped_words_leave_no_gap(spark):
    df = spark.createDataFrame([("the cats of the  hats the",), ("the",), ("",), (None,)], "t string").coalesce(1)
    out = [r[0] for r in df.select(stemming.stem_text(F.col("t"), dropped=["the", "of"])).collect()]
    assert out[:3] == ["cat hat", "", ""]


def test_fused_stemming_equals_the_three_steps(spark):
    texts = ["Running cats and the dogs' external links http://x.org [[category:Big cats]]", "", None,
             "{{infobox would couldn't sizes}} a  b external links [[category:x]]"]
    pages = spark.createDataFrame([(str(i), "The Titles é", t) for i, t in enumerate(texts)],
                                  "Id string, Title string, Text string")
    documents = field_documents(pages)
    steps = stem_documents(drop_stop_words(tokenize_documents(documents)))
    assert sorted(stemmed_documents(documents).collect()) == sorted(steps.select("Id", *v.FIELDS).select(
        stemmed_documents(documents).columns).collect())


def test_index_stop_words_are_sparks_own(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert StopWordsRemover.loadDefaultStopWords("english") == v.INDEX_STOP_WORDS


def test_stop_word_filter_equals_the_transformer(spark):
    from pyspark.ml.feature import StopWordsRemover
    from termfold.functions.tokens import without_index_stop_words

    df = spark.createDataFrame([(["the", "planet", "would", "planet", "couldn't", "x"],), ([],)], "words array<string>")
    theirs = StopWordsRemover(inputCol="words", outputCol="kept").transform(df)
    rows = theirs.withColumn("ours", without_index_stop_words(F.col("words"))).collect()
    assert all(row.kept == row.ours for row in rows)


def test_lines_are_split_in_bounded_runs(monkeypatch):
    lines = pa.array(["the planets", None, "", "x " * 50 + "cats", *["running dogs"] * 40, "cats"])
    whole = stemming.stem_lines(lines, "extended", frozenset(["the"])).to_pylist()
    monkeypatch.setattr(stemming, "SLICE_BYTES", 60)
    runs = stemming.slices(lines)
    assert pa.concat_arrays(runs).equals(lines)
    assert all(sum(len(x or "") for x in run.to_pylist()) <= 60 + 12 for run in runs if len(run) > 1)
    assert [x for run in runs for x in stemming.stem_lines(run, "extended", frozenset(["the"])).to_pylist()] == whole
    assert [run.to_pylist() for run in stemming.slices(pa.array([], pa.string()))] == [[]]
