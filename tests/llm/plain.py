"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

from collections import Counter, defaultdict
from zlib import crc32


def held_out(doc_id) -> bool:
    return doc_id is not None and crc32(str(doc_id).encode()) % 3 == 1


# --- language -----------------------------------------------------------------------


def ngrams(text):
    folded = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text)
    padded = " " + " ".join(folded.split(" ")) + " "
    while "  " in padded:
        padded = padded.replace("  ", " ")
    grams = [c for c in padded if c != " "]
    for n in (2, 3):
        grams += [padded[i : i + n] for i in range(len(padded) - n + 1)]
    return Counter(grams) if padded.strip() else Counter()


def _order(gram):
    key = 0
    for c in gram:
        key = (key << 21) | (1 if c == " " else ord(c))
    return key


def ranked(counts, size):
    return sorted(counts, key=lambda g: (-counts[g], _order(g)))[:size]


def profiles(rows, size):
    """rows: (text, lang)."""
    by_lang = defaultdict(Counter)
    for text, lang in rows:
        if text is not None and lang is not None:
            by_lang[lang].update(ngrams(text))
    return {lang: ranked(counts, size) for lang, counts in by_lang.items() if counts}


def nearest(text, learned, size):
    own = ranked(ngrams(text or ""), size)
    if not own or not learned:
        return "und", 0.0
    best = []
    for lang, profile in learned.items():
        place = {g: i for i, g in enumerate(profile)}
        best.append((sum(abs(place[g] - i) if g in place else size for i, g in enumerate(own)), lang))
    distance, lang = min(best)
    return lang, 1 - distance / (size * len(own))


# --- lines ---------------------------------------------------------------------------


def word_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def dedup_lines(docs, near_words, copy_share=None):
    """docs: (doc_id, text), any order; the text of each row without repeated lines."""
    first, lines = {}, []
    for row, (doc_id, text) in enumerate(docs):
        for number, line in enumerate((text or "").split("\n") if text is not None else ()):
            words = tuple(line.encode().split())
            if words:
                place = (-(1 << 63) if doc_id is None else doc_id, number)
                lines.append((place, words, row))
                first[words] = min(first.get(words, place), place)
    owner = {}
    for words, place in first.items():
        near = [
            other for earlier, other in first.items()
            if other < place and min(len(words), len(earlier)) >= near_words and abs(len(words) - len(earlier)) <= 1
            and word_distance(words, earlier) <= 1
        ]
        owner[words] = min(near, default=None)
    gone = defaultdict(dict)
    for place, words, row in lines:
        if owner[words] is not None or place != first[words]:
            gone[row][place[1]] = (owner[words] or first[words])[0]
    if copy_share is not None:
        for row, (doc_id, text) in enumerate(docs):
            size, own = {n: len(line.encode().split()) for n, line in enumerate((text or "").split("\n"))}, Counter()
            for n, of in gone[row].items():
                if of != (-(1 << 63) if doc_id is None else doc_id):
                    own[of] += size[n]
            if own:
                most = min(own, key=lambda of: (-own[of], of))
                if own[most] >= copy_share * sum(size.values()):
                    gone[row] = {n: of for n, of in gone[row].items() if of != most}
    return [
        None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[row])
        for row, (_, text) in enumerate(docs)
    ]


# --- similarity ------------------------------------------------------------------------


def shingles(text, words=5):
    found = (text or "").encode().lower().split()
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def near_duplicates(docs):
    """docs: (doc_id, text); (doc_id, n_shingles, component) of each row."""
    sets = [shingles(text) for _, text in docs]
    root = {i: i for i, _ in docs if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, _) in enumerate(docs):
        for j in range(i):
            b = docs[j][0]
            shared = len(sets[i] & sets[j])
            if a is not None and b is not None and shared and 100 * shared >= 80 * len(sets[i] | sets[j]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(i, len(s), None if i is None else find(i)) for (i, _), s in zip(docs, sets)]


# --- mixing -----------------------------------------------------------------------------


def rake(cells, targets, sweeps=200):
    """cells: {values: tokens}; targets: one {value: share} for each place in the values. Fitted weights."""
    weight = {values: float(tokens) for values, tokens in cells.items()}
    for _ in range(sweeps):
        for place, shares in enumerate(targets):
            have = Counter()
            for values, w in weight.items():
                have[values[place]] += w
            for values in weight:
                h = have[values[place]]
                weight[values] *= shares.get(values[place], 0.0) / h if h else 0.0
    return weight


def evened(cells, place, temperature):
    sums = Counter()
    for values, tokens in cells.items():
        sums[values[place]] += tokens
    wish = {v: t**temperature for v, t in sums.items() if t}
    total = sum(wish.values())
    return {v: w / total for v, w in wish.items()}


def probabilities(cells, weight, keep):
    total = sum(cells.values())
    full = set()
    while True:
        room = keep * total - sum(cells[c] for c in full)
        rest = sum(w for c, w in weight.items() if c not in full and cells[c]) * total
        scale = room / rest if rest else 0.0
        more = {c for c, w in weight.items() if cells[c] and c not in full and w * total / cells[c] * scale >= 1}
        if not more:
            break
        full |= more
    return {c: keep if not t else 1.0 if c in full else weight[c] * total / t * scale for c, t in cells.items()}
