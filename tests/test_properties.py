"""Random inputs against slower or independent forms of the same operator."""

import random
import re

import duckdb
from pyspark.sql import functions as F

import duckdb_oracle
from termfold import values as v
from termfold.functions import clean, fields
from termfold.functions.porter import PorterStemmer

PIECES = ["{{infobox", "{{", "}}", "{", "}", "a", " ", "\n", "infobox"]


def matching_end(text):
    """Length of the balanced part at the start of ``text``, found by shrinking it token by token."""
    depth, used = 0, 0
    while used < len(text):
        pair = text[used : used + 2]
        step = 2 if pair in ("{{", "}}") else 1
        depth += {"{{": 1, "}}": -1}.get(pair, 0)
        used += step
        if depth == 0 and step == 2:
            return used
    return None


def boxes_and_rest(text):
    boxes = []
    while "{{infobox" in text:
        text = text[text.index("{{infobox") :]
        end = matching_end(text)
        if end is None:
            break
        boxes.append(text[9 : end - 2])
        text = text[end:]
    return boxes, text


def random_texts(pieces, count, longest, seed):
    random.seed(seed)
    return ["".join(random.choices(pieces, k=random.randrange(longest))) for _ in range(count)]


def test_infobox_positions(spark):
    texts = random_texts(PIECES, 6000, 25, seed=4) + ["", "{{infobox", "}}{{infobox}}", "{{{{infobox a}}}} b", "{{infobox {{{}}} }}}} c"]
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select("t", fields.infobox_positions(F.col("t")).alias("p")).collect()
    for row in rows:
        found = row.p or {"boxes": [], "rest": 0}
        inside = [row.t[box["at"] + 9 : box["at"] + box["size"] - 2] for box in found["boxes"]]
        assert (inside, row.t[found["rest"] :]) == boxes_and_rest(row.t), row.t
    assert any(row.p and len(row.p.boxes) > 1 for row in rows)


def test_links_and_body_equal_their_patterns(spark):
    pieces = ["external links", "[[category", ":a]]", " ", "\n", "\t", "x", "external", "[["]
    texts = random_texts(pieces, 4000, 12, seed=5)
    t = F.col("t")
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select(
        "t",
        fields.extract_external_links(t).alias("links"),
        fields.extract_body(t).alias("body"),
    ).collect()
    for row in rows:
        # The two field patterns as they are stated.
        links = re.search(r"(?s).*external links\s*([\s\S]*?)\s*\[\[category", row.t)
        body = re.search(r"(?s)(.*)external links", row.t)
        assert row.links == (links.group(1) if links else ""), row.t
        assert row.body == (body.group(1) if body else ""), row.t


def test_cleaning_equals_the_plain_patterns(spark):
    pieces = ["{{cite ", "{{vcite\n", "{{cite", "}}", "}", "[[file:", "]]", "]", "<", ">", ".", "é", "a", " ", "/", "\n"]
    texts = random_texts(pieces, 4000, 15, seed=6)
    t = F.col("t")
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select(
        "t",
        clean.clean_body_sequential(t).alias("steps"),
        clean.clean_body_single_pass(t).alias("single"),
    ).collect()
    sql = f"SELECT x, {duckdb_oracle.sequential('x')}, {duckdb_oracle.single_pass('x')} FROM (SELECT unnest(?) AS x)"
    expected = {x: (a, b) for x, a, b in duckdb.connect().execute(sql, [texts]).fetchall()}
    assert all((row.steps, row.single) == expected[row.t] for row in rows)


def test_squeezing_equals_the_steps(spark):
    pieces = list("~`!@#$%-^*+{}[]|\\<>/?,:&ab_é \n\t\r\x0b\xa0'")
    texts = random_texts(pieces, 3000, 12, seed=8)
    t = F.col("t")
    squeeze = clean.squeeze_whitespace
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select(
        clean.squeeze_junk(t), squeeze(clean.strip_junk(t)),
        clean.squeeze_infobox(t), squeeze(clean.clean_infobox(t)),
    ).collect()
    assert all(row[0] == row[1] and row[2] == row[3] for row in rows)


def test_stems_equal_the_regular_expressions():
    random.seed(9)
    endings = """s es ies sses ed ied eed ing y ly alli ational tional enci anci izer bli abli entli eli ousli
        ization ation ator alism iveness fulness ousness aliti iviti biliti fulli logi icate ative alize iciti
        ical ful ness al ance ence er ic able ible ant ement ment ent sion tion ion ou ism ate iti ous ive ize e ll
        at bl iz tt ss zz""".split()
    words = {
        "".join(random.choices("aeioubcdlnrstxyyz", k=random.randrange(6))) + "".join(random.choices(endings, k=random.randrange(4)))
        for _ in range(20_000)
    } | set(duckdb_oracle.OWN_STEMS) | {"é", "naïveness", "1990s", "x's"}
    words = sorted(words - {""})
    sql = "WITH words AS (SELECT unnest(?) AS Word), " + ", ".join(duckdb_oracle.stems("words"))
    expected = dict(duckdb.connect().execute(sql + " SELECT Word, Stem FROM stems", [words]).fetchall())
    stem = PorterStemmer().stem
    assert {w: stem(w) for w in words} == expected


def test_query_stop_list_has_no_repeats():
    assert len(set(v.QUERY_STOP_WORDS)) == len(v.QUERY_STOP_WORDS) == 179
