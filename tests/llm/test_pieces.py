import os
import random

import numpy as np
import pytest

from termfold.llm import pieces

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.TOKENIZER), reason="no tokenizer files")
ODD = ["", " ", "  ", "\n", "▁", " ▁▁ a▁b ", "tab\tand\r\nline\n\n end ", "\x00\x01", "漢字かな交じり", "🙂🙃\U0010ffff", "a" * 5000,
       "Pneumonoultramicroscopicsilicovolcanoconiosis", "<0x41><s></s><unk>", "İstanbul ß ﬁ", "def f(x):\n    return x  # ok"]


@pytest.fixture(scope="module")
def model():
    return pieces.read_model()


def some_texts():
    draw = random.Random(3)
    letters = "etaoin shrdlu\n  .,()_#9éüß漢"
    return ODD + ["".join(draw.choice(letters) for _ in range(draw.randrange(1, 300))) for _ in range(60)]


def encoded(encoder, texts, ids=None):
    tokens, ends = encoder(texts, list(range(len(texts))) if ids is None else ids)
    return [tokens[a:b].tolist() for a, b in zip(ends, ends[1:])]


def test_without_dropout_equals_the_library(model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    # The library turns the meta symbol itself into a blank, which is not lossless.
    texts = [t for t in some_texts() if "▁" not in t]
    assert encoded(pieces.Encoder(model, 0.0, 0), texts) == [library.encode(t) for t in texts]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_lossless(model, dropout):
    encoder = pieces.Encoder(model, dropout, 7)
    texts = some_texts()
    for text, tokens in zip(texts, encoded(encoder, texts)):
        assert encoder.pieces.decoded(tokens) == text if text else not tokens


def by_the_rule(own, part, key, threshold):
    """The best-scored candidate that has not been skipped, the leftmost of equals, until there is none."""
    symbols, skipped = [(i, c) for i, c in enumerate(part)], set()
    while True:
        candidates = []
        for (left, a), (right, b) in zip(symbols, symbols[1:]):
            if a + b in own.rank and (left, right, a + b) not in skipped:
                candidates.append((own.rank[a + b], left, right, a + b))
        if not candidates:
            return [s for _, s in symbols]
        _, left, right, piece = min(candidates)
        x = ((key ^ (left * 0x9E3779B97F4A7C15)) + own.id[piece] * 0xD6E8FEB86659FD93) % 2**64
        x = ((x ^ (x >> 32)) * 0xBF58476D1CE4E5B9) % 2**64
        if x >> 32 < threshold:
            skipped.add((left, right, piece))
        else:
            symbols = [(i, piece if i == left else s) for i, s in symbols if i != right]


def test_every_occurrence_draws_for_itself(model):
    """The memory and the agendas side by side give what the rule gives for each occurrence."""
    encoder = pieces.Encoder(model, 0.3, 5)
    own = encoder.pieces
    texts = [t for t in some_texts() if len(t) < 1000 and "▁" not in t] * 3
    ids = [i // 2 for i in range(len(texts))]
    for _ in range(2):  # at first nothing is remembered
        for text, doc, tokens in zip(texts, ids, encoded(encoder, texts, ids)):
            key = np.array([pieces.document_key(5, doc)], np.uint64)
            want = []
            for place, part in enumerate(own.parts("▁" + text.replace(" ", "▁")) if text else []):
                of_part = int(pieces.occurrence_keys(key, np.array([place]))[0])
                want += own.ids(by_the_rule(own, part, of_part, encoder.threshold))
                assert by_the_rule(own, part, of_part, encoder.threshold) == own.segmented(part, of_part, encoder.threshold)
            assert tokens == want


def test_memory_is_bounded_and_changes_nothing(model, monkeypatch):
    texts = some_texts()
    expected = encoded(pieces.Encoder(model, 0.2, 1), texts)
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    encoder = pieces.Encoder(model, 0.2, 1)
    assert [encoded(encoder, [t], [i])[0] for i, t in enumerate(texts)] == expected


def test_rate_and_variety(model):
    encoder = pieces.Encoder(model, 0.1, 3)
    tokens = encoded(encoder, [" ".join(["international"] * 4000)])[0]
    cuts, word = {}, []
    for t in tokens + [None]:
        if t is None or encoder.pieces.bytes_of[t].startswith(b" "):
            cuts[tuple(word)] = cuts.get(tuple(word), 0) + 1
            word = []
        word.append(t)
    assert len(cuts) > 20
    draw = random.Random(8)
    rule = [len(by_the_rule(encoder.pieces, "▁international", draw.getrandbits(64), encoder.threshold)) == 1 for _ in range(1500)]
    assert abs(max(cuts.values()) / 4000 - sum(rule) / 1500) < 0.05
    assert encoded(encoder, ["a b"], [1]) == encoded(pieces.Encoder(model, 0.1, 3), ["a b"], [1])
    assert encoded(encoder, [" ".join(["understanding"] * 50)], [1]) != encoded(encoder, [" ".join(["understanding"] * 50)], [2])


def test_table_with_odd_rows(spark, model):
    rows = [(i, t, "old", 5) for i, t in enumerate(ODD)] + [(None, "x y", "old", 5), (3, None, "old", 5), (3, ODD[6], "old", 5), (3, ODD[6], "old", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lossless string, N_Tokens int").repartition(3)
    found = pieces.encode(docs, model, dropout=0.2)
    assert found.columns == ["doc_id", "text", "tokens", "n_tokens", "lossless"]
    back = pieces.decode(found.withColumnRenamed("text", "was"), model).collect()
    assert len(back) == len(rows)
    for r in back:
        assert r.text == r.was
        if r.was is None:
            assert r.tokens is None and r.n_tokens is None and r.lossless is None
        else:
            assert r.lossless and r.n_tokens == len(r.tokens)
    repeated = [r.tokens for r in back if r.doc_id == 3 and r.was == ODD[6]]
    assert len(repeated) == 2 and repeated[0] == repeated[1]
    assert pieces.encode(docs.limit(0), model).collect() == []


def test_pairs_are_found_by_hash_also_where_hashes_are_shared(monkeypatch):
    for bits in (2, 20):
        monkeypatch.setattr(pieces, "_HASH_BITS", bits)
        model = pieces.Pieces(pieces.read_model())
        place = {key: i for i, key in enumerate(model.pairs[:-1].tolist())}
        some = np.array(list(place)[:: max(1, len(place) // 200)], np.int64)
        asked = np.concatenate([some, some + 1, some - (some % pieces._SYMBOLS) - 1])
        left, right = asked // pieces._SYMBOLS, asked % pieces._SYMBOLS
        expected = [place.get(key, len(place)) for key in asked.tolist()]
        assert model._pair(left, right).tolist() == expected
        assert model._pair(left.reshape(3, -1), right.reshape(3, -1)).ravel().tolist() == expected


def test_tables_of_an_agenda_are_narrow():
    model = pieces.Pieces(pieces.read_model())
    shared = model.piece_of < 0
    assert model.pair_order.dtype == np.int32 and 0 < (~shared).sum()
    words = ["▁international", "▁understanding", "aé漢", "▁", "ab" * 40, "▁\U0001f600x"]
    keys = np.arange(len(words), dtype=np.uint64)
    for threshold in (0, 1 << 29, 1 << 32):
        for narrowed in (model.piece_of, np.full_like(model.piece_of, -1)):
            model.piece_of = narrowed
            together = model.segmented_together(words, keys, threshold)
            alone = [np.array(model.ids(model.segmented(w, int(k), threshold)), np.int32).tobytes() for w, k in zip(words, keys)]
            assert together[0] == alone
            plain = model.segmented_together(words, keys, threshold, candidates=False)
            assert plain[0] == alone and len(plain[1]) == 0


def test_tokens_of_many_parts_stand_one_after_the_other():
    model = pieces.Pieces(pieces.read_model())
    parts = ["", "▁\U0001f600xࠀ", "▁understanding", "a" * 70, "▁", "▁the", "é"]
    keys = np.arange(len(parts), dtype=np.uint64)
    for threshold in (0, 1 << 30, 1 << 32):
        tokens, sizes, *_ = model.together(parts, keys, threshold)
        ends = np.cumsum(sizes)
        alone = [model.ids(model.segmented(w, int(k), threshold)) for w, k in zip(parts, keys)]
        assert [tokens[a:b].tolist() for a, b in zip([0, *ends], ends)] == alone
    empty = model.together([], keys[:0])
    assert [len(x) for x in empty] == [0] * 5
