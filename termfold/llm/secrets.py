"""Secret scan: fixed patterns, and novelty measured by a compressor primed with what surrounds a candidate.

Base patterns find assignments, access keys and long hexadecimal strings. Beyond these, every value at most ``REACH`` code
points away from a word that speaks of secrets is measured: a run of key characters, cut at the name and sign before it,
of at least ``LEAST`` characters, or ``LEAST_PLAIN`` if it is letters of one case, or digits and signs (dates). Its novelty is what it
adds to the zstandard size of its surroundings, for a compressor primed with an identifier dictionary (:data:`IDENTIFIERS`
and names derived from the context words). A ground text in front gives short surroundings the statistics of ordinary
text. Names, words, paths and repeated text add little; a random string adds its entropy. So the bound is the entropy of
as many characters of the candidate's own alphabet: values that add at least ``NOVEL_SHARE`` of it are reported as kind
``novel`` (``PLAIN_SHARE`` for letters of one case, where words of a foreign language come close).

Not measured are names: several parts of four letters or more on average, joined by case, ``_``, ``-`` or ``/``, with
numbers of at most two digits.

Defined results: a null or empty text has no spans. Positions are code points, ends exclusive. Base spans of different
kinds may overlap; a ``novel`` span never overlaps a base span. Each row is scanned on its own, so repeated rows and null
ids have results of their own. :func:`scan` keeps other columns and replaces those of its own names.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from functools import cache
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from termfold.llm.arrays import with_text_columns

# Fixed patterns; only the words before the sign are taken in either case.
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex")
NOVEL = "novel"

#: Words that make their surroundings sensitive.
CONTEXT = re.compile(
    r"(?ai:password|passwd|passphrase|secret|token|api_?key|credential|private_?key|access_?key|bearer|authorization)"
)
CONTEXT_PROBES = ("pass", "secret", "token", "key", "credential", "bearer", "authorization")
#: Signs that pad a value stand at its end; before it they end a name.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{10,}={0,2}")
REACH = 64
SURROUNDINGS = 512
LEAST, LEAST_PLAIN = 10, 16
NOVEL_SHARE, PLAIN_SHARE = 0.95, 1.0
#: Alphabets by size; the last takes every key character.
ALPHABETS = tuple(
    (re.compile(f"[{chars}]+"), math.log2(size) / 8)
    for chars, size in (
        ("0-9", 10), ("0-9a-f", 16), ("0-9A-F", 16), ("a-z", 26), ("A-Z", 26), ("0-9a-z", 36), ("0-9A-Z", 36),
        ("A-Za-z", 52), ("0-9A-Za-z", 62), ("0-9A-Za-z+/_=-", 64),
    )
)
PLAIN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9/_+-]+(?:T[0-9]+)?={0,2}")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+|[+=]")
GROUND = (
    "When a caller asks for an object that was never written, this function returns nothing and leaves its input alone; "
    "otherwise every row is read once, checked against what had been agreed before, and passed along in the order of "
    "arrival. Errors raise at once, with a message that names the file, its line and the number 42, 1970 or 3600 at fault. "
    "if not found: return [x for x in rows[0:10] if x > 5]; while (i < 8) { sum += data[i]; } Keep It Simple, OK? "
)
#: Names that code is full of.
IDENTIFIERS = """
abstract action address algorithm append argument array async attribute base64 begin boolean branch buffer build
callback case certificate char check class cluster code column command compare compile connection const container
content continue control cookie count current cursor date debug default define deploy description directory disable
double download else email encode encoding engine enum error event exception execute extends extract field file
final finally float folder format from generate global handler hash host html https identifier implements import
info init insert instance interface internal join json language length limit list load local logger login manager
memory metadata method migration model name namespace network node number object open operator order output page
parameter parse partition pattern permission policy pool prefix primary private process project property provider
proxy query queue range read record reference region register remote remove report repository require reset response
result role root sample schema script search select self sequence server set signature sleep socket source split
start state status stop stream string submit super sync system target task test text throw time timestamp title
transaction transform true type unique update url user validate value vector version void volatile warning while
window worker yield
""".split()

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base patterns, by start, then kind."""
    spans = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def identifier_dictionary() -> bytes:
    """Names that code is full of; the likeliest last, as zstandard likes it."""
    parts = ("access", "api", "auth", "client", "config", "default", "key", "max", "password", "secret", "session",
             "token", "user", "value")
    joined = [f"{a}_{b}" for a in parts for b in parts if a != b]
    return "\n".join([*IDENTIFIERS, *joined, *(a.upper() for a in joined)]).encode()


@cache
def _compressor() -> zstandard.ZstdCompressor:
    primer = zstandard.ZstdCompressionDict(identifier_dictionary(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=3, dict_data=primer, write_checksum=False, write_content_size=False)


def novelty(before: str, candidate: str, after: str) -> float:
    """Bytes that ``candidate`` adds to the compressed size of its surroundings."""
    around = (GROUND + before + after).encode("utf-8", "replace")
    size = _compressor().compress
    return len(size(around + candidate.encode("utf-8", "replace"))) - len(size(around))


def entropy(candidate: str) -> float:
    """Bytes of as many characters drawn from the smallest alphabet that holds the candidate's."""
    return len(candidate) * next(bits for chars, bits in ALPHABETS if chars.fullmatch(candidate))


def is_name(candidate: str) -> bool:
    """Several parts that are words or short numbers."""
    parts = NAME_PART.findall(candidate)
    words = [p for p in parts if p.isalpha()]
    rest = [p for p in parts if not p.isalpha()]
    return len(words) > 1 and sum(map(len, words)) >= 4 * len(words) and all(p.isdigit() and len(p) <= 2 for p in rest)


def is_novel(before: str, candidate: str, after: str) -> bool:
    plain = PLAIN.fullmatch(candidate) is not None
    if len(candidate) < (LEAST_PLAIN if plain else LEAST) or is_name(candidate):
        return False
    share = PLAIN_SHARE if plain and candidate.isalpha() else NOVEL_SHARE
    return novelty(before, candidate, after) >= share * entropy(candidate)


def novel_spans(text: str, base: list[Span]) -> list[Span]:
    """Candidates near context words that their surroundings do not explain."""
    lower = text.lower()
    if not any(word in lower for word in CONTEXT_PROBES):
        return []
    contexts = [m.span() for m in CONTEXT.finditer(text)]
    starts = [start for start, _ in contexts]
    base_starts = [start for start, _, _ in base]
    base_ends = list(accumulate((end for _, end, _ in base), max))
    spans = []
    for m in CANDIDATE.finditer(text) if contexts else ():
        # Context words don't overlap, so the last that starts before the reach's end is the nearest.
        last = bisect_right(starts, m.end() + REACH) - 1
        if last < 0 or contexts[last][1] < m.start() - REACH:
            continue
        before_end = bisect_left(base_starts, m.end())
        if before_end and base_ends[before_end - 1] > m.start():
            continue
        before = text[max(0, m.start() - SURROUNDINGS) : m.start()]
        after = text[m.end() : m.end() + SURROUNDINGS]
        if is_novel(before, m.group(), after):
            spans.append((m.start(), m.end(), NOVEL))
    return spans


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _columns(texts: pa.Array) -> list[pa.Array]:
    counts: list[list[int]] = [[], [], []]
    hashes, every = [], []
    for text in texts.to_pylist():
        base = base_spans(text) if text else []
        for kind, column in zip(KINDS, counts):
            column.append(sum(s[2] == kind for s in base))
        hashes.append(hashlib.sha256(joined(base).encode()).hexdigest())
        novel = novel_spans(text, base) if text else []
        order = (*KINDS, NOVEL)
        every.append(joined(sorted(base + novel, key=lambda s: (s[0], order.index(s[2])))))
    return [*(pa.array(c, pa.int64()) for c in counts), pa.array(hashes, pa.string()), pa.array(every, pa.string())]


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_assign, n_access, n_hex, base_sha256, spans`` of each whole ``text``."""
    added = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return with_text_columns(docs, _columns, added)


def op4_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).drop("text")
