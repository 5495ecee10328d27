"""Porter's suffix-stripping algorithm (Program 14(3), 1980), one word at a time.

Two modes: ``extended`` (default) has the usual later departures: short and
irregular words are left alone, and a few endings are treated more carefully;
``paper`` is the algorithm as printed.

A word is reduced to a string of ``c`` and ``v`` (consonant, vowel) first; the
paper's conditions are then small patterns over that string.
"""

from __future__ import annotations

import re

TWO_RUNS = re.compile("vc")

# --- fixed values: the paper's suffix tables, tried from top to bottom -------
STEP_2 = """
ational ate  tional tion  enci ence  anci ance  izer ize  bli ble  alli al  entli ent  eli e
ousli ous  ization ize  ation ate  ator ate  alism al  iveness ive  fulness ful  ousness ous
aliti al  iviti ive  biliti ble  fulli ful  logi log
"""
STEP_2_PAPER = """
ational ate  tional tion  enci ence  anci ance  izer ize  abli able  alli al  entli ent  eli e
ousli ous  ization ize  ation ate  ator ate  alism al  iveness ive  fulness ful  ousness ous
aliti al  iviti ive  biliti ble
"""
STEP_3 = "icate ic  ative -  alize al  iciti ic  ical ic  ful -  ness -"
STEP_4 = tuple("""
al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize
""".split())

# --- fixed values: words with a stem of their own (extended mode) ------------
IRREGULAR = {
    "sky": "sky", "skies": "sky",
    "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news",
    "innings": "inning", "inning": "inning",
    "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning",
    "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}


def pairs(table: str) -> dict[str, str]:
    words = ["" if word == "-" else word for word in table.split()]
    return dict(zip(words[::2], words[1::2]))


def shape(word: str) -> str:
    """``c``/``v`` per letter; a ``y`` is a vowel exactly when it follows a consonant."""
    letters = []
    previous = "v"
    for letter in word:
        if letter in "aeiou" or (letter == "y" and previous == "c"):
            previous = "v"
        else:
            previous = "c"
        letters.append(previous)
    return "".join(letters)


def measure(word: str) -> int:
    """How many times a vowel run is followed by a consonant run."""
    return len(TWO_RUNS.findall(shape(word)))


def has_vowel(word: str) -> bool:
    return "v" in shape(word)


class PorterStemmer:
    def __init__(self, mode: str = "extended"):
        if mode not in ("extended", "paper"):
            raise ValueError(f"unknown stemmer mode: {mode}")
        self.extended = mode == "extended"
        self.step_2 = pairs(STEP_2 if self.extended else STEP_2_PAPER)
        self.step_3 = pairs(STEP_3)

    def stem(self, word: str) -> str:
        word = word.lower()
        if self.extended:
            if word in IRREGULAR:
                return IRREGULAR[word]
            if len(word) <= 2:
                return word
        word = self.participles(self.plurals(word))
        word = self.final_y(word)
        word = self.double_suffixes(word)
        word = self.replace_first(word, self.step_3)
        word = self.drop_suffix(word)
        return self.tidy(word)

    def ends_short(self, word: str) -> bool:
        """Consonant, vowel, consonant other than w, x, y at the end."""
        if shape(word).endswith("cvc") and word[-1] not in "wxy":
            return True
        return self.extended and shape(word) == "vc"

    @staticmethod
    def replace_first(word: str, table: dict[str, str]) -> str:
        """The first suffix that fits decides, also when its stem is too short."""
        if not word.endswith(tuple(table)):
            return word
        suffix = next(suffix for suffix in table if word.endswith(suffix))
        stem = word[: -len(suffix)]
        return stem + table[suffix] if measure(stem) > 0 else word

    def plurals(self, word: str) -> str:
        if self.extended and len(word) == 4 and word.endswith("ies"):
            return word[:-1]
        if word.endswith(("sses", "ies")):
            return word[:-2]
        if word.endswith("s") and not word.endswith("ss"):
            return word[:-1]
        return word

    def participles(self, word: str) -> str:
        if self.extended and word.endswith("ied"):
            return word[:-1] if len(word) == 4 else word[:-2]
        if word.endswith("eed"):
            return word[:-1] if measure(word[:-3]) > 0 else word
        if word.endswith("ed") and has_vowel(word[:-2]):
            return self.mend(word[:-2])
        if word.endswith("ing") and has_vowel(word[:-3]):
            return self.mend(word[:-3])
        return word

    def mend(self, stem: str) -> str:
        """Restore the ending of a stem that lost -ed or -ing."""
        if stem.endswith(("at", "bl", "iz")):
            return stem + "e"
        if len(stem) > 1 and stem[-1] == stem[-2] and shape(stem)[-1] == "c":
            return stem if stem[-1] in "lsz" else stem[:-1]
        if measure(stem) == 1 and self.ends_short(stem):
            return stem + "e"
        return stem

    def final_y(self, word: str) -> str:
        stem = word[:-1]
        if not word.endswith("y"):
            return word
        if self.extended:
            applies = len(stem) > 1 and shape(stem)[-1] == "c"
        else:
            applies = has_vowel(stem)
        return stem + "i" if applies else word

    def double_suffixes(self, word: str) -> str:
        if self.extended:
            if word.endswith("alli") and measure(word[:-4]) > 0:
                return self.double_suffixes(word[:-2])
            if word.endswith("logi"):
                return word[:-1] if measure(word[:-3]) > 0 else word
        return self.replace_first(word, self.step_2)

    @staticmethod
    def drop_suffix(word: str) -> str:
        if not word.endswith(STEP_4):
            return word
        suffix = next(suffix for suffix in STEP_4 if word.endswith(suffix))
        stem = word[: -len(suffix)]
        if measure(stem) > 1 and (suffix != "ion" or stem[-1] in "st"):
            return stem
        return word

    def tidy(self, word: str) -> str:
        if word.endswith("e"):
            stem = word[:-1]
            if measure(stem) > 1 or (measure(stem) == 1 and not self.ends_short(stem)):
                word = stem
        if word.endswith("ll") and measure(word[:-1]) > 1:
            word = word[:-1]
        return word
