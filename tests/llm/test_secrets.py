import hashlib
import random
import re

import pytest

from termfold.llm import secrets

# The three patterns as they are stated, as a yardstick.
KINDS = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", r"AKIA[A-Z0-9]+"),
    ("hex", r"[0-9a-f]+"),
)


def plain(text):
    spans = []
    for at, (kind, pattern) in enumerate(KINDS):
        flags = re.ASCII | (re.IGNORECASE if kind == "assign" else 0)
        for m in re.finditer(pattern, text, flags):
            size = len(m.group(2)) if kind == "assign" else len(m.group())
            if size >= (6, 20, 24)[at]:
                spans.append((m.start(), at, m.end()))
    return ",".join(f"{KINDS[at][0]}:{start}:{end}" for start, at, end in sorted(spans))


def texts():
    draw = random.Random(5)
    bits = ["password", "PassWd", "ſecret", "toKen", "toKen", "api_key", "APIKEY", "=", ":", " ", "'", '"', "AKIA", "A1B2C3D4E5F6G7H8",
            "0123456789abcdef", "deadbeef", "é", "\n", "x", "hunter2hunter", ".", "-", "🙂"]
    return ["".join(draw.choice(bits) for _ in range(draw.randrange(1, 40))) for _ in range(400)]


def test_base_spans():
    for text in texts():
        assert secrets.joined(secrets.base_spans(text)) == plain(text)


def test_novel_strings_near_context_words():
    found = lambda text: [text[s:e] for s, e, _ in secrets.novel_spans(text, secrets.base_spans(text))]
    random_ = "q7ZpX2vLk9TfWm4RsB1y"
    code = "def connect(config):\n    # the credential of the session\n    use("
    assert found(code + f'"{random_}")\n') == [random_]
    assert found(code + "default_client_session_value_1)") == []
    assert found(f"nothing of that kind here {random_} at all") == []
    assert found(f"credential {random_} and again {random_} and {random_}") == []
    assert found("credential " + "x" * 200 + f" {random_}") == []
    # A base span is not reported twice.
    assert found(f"token = {random_}") == []


def shares(alphabet, length, before, after="", n=200):
    draw = random.Random(9)
    hits = 0
    for _ in range(n):
        value = "".join(draw.choices(alphabet, k=length))
        text = before + value + after
        spans = secrets.novel_spans(text, secrets.base_spans(text))
        hits += (len(before), len(before) + length) in [s[:2] for s in spans]
    return hits / n


ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


@pytest.mark.parametrize(
    "alphabet, length, before, after",
    [
        (ALNUM[:52], 20, "credential: ", ""),
        (ALNUM[26:52], 20, "credential: ", ""),
        (ALNUM, 12, "credential: ", ""),
        ("0123456789ABCDEF", 256, "credential: ", ""),
        (ALNUM + "+/", 16, "credential: ", ""),
        (ALNUM + "+/", 20, "private_key: ", ""),
        (ALNUM, 20, "access_key=", ""),
        (ALNUM, 40, "AWS_SECRET_ACCESS_KEY=", "\nREGION=north\n"),
        (ALNUM, 24, "    # bearer of the session\n    header('", "')\n    return client\n"),
    ],
)
def test_random_values_are_found_whatever_their_alphabet(alphabet, length, before, after):
    assert shares(alphabet, length, before, after) > 0.85


def test_names_words_and_dates_are_not():
    for name in ["MAX_CONNECTION_RETRIES", "AbstractAuthenticationProvider", "client_secret_expires_at", "application/octet-stream",
                 "getUserSessionToken2", "understanding", "2024-01-15", "default_client_session_value_1", "Verschlüsselung"]:
        text = f"the credential of the session is {name} as before"
        assert secrets.novel_spans(text, secrets.base_spans(text)) == [], name


def test_dictionary_is_the_packages_own():
    """Spans do not change with the version of Python."""
    assert hashlib.sha256(secrets.identifier_dictionary()).hexdigest()[:8] == "de5c0608"
    assert len(set(secrets.IDENTIFIERS)) == len(secrets.IDENTIFIERS)


def test_table_with_odd_rows(spark):
    long = "words " * 50_000 + "password: abcdef123" + " more" * 1000
    rows = [(1, None), (2, ""), (3, long), (None, "AKIA" + "Z" * 16), (4, "0" * 24), (4, "0" * 24), (5, "bearer q7ZpX2vLk9TfWm4RsB1y")]
    docs = spark.createDataFrame([(*row, 9, "old") for row in rows], "doc_id long, text string, n_hex int, spans string").repartition(2)
    found = sorted(secrets.scan(docs).collect(), key=lambda r: (r.doc_id or 0, r.text or ""))
    assert len(found) == len(rows)
    for r in found:
        base = plain(r.text or "")
        kinds = [s.split(":")[0] for s in base.split(",")] if base else []
        assert [r.n_assign, r.n_access, r.n_hex] == [kinds.count(k) for k in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert r.spans == base or "novel" in r.spans
    assert found[-1].spans == "novel:7:27"
    assert secrets.scan(docs.limit(0)).collect() == []
