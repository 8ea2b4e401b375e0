"""Suffix stripping after Porter (1980), as a small per-word helper."""

from __future__ import annotations

from functools import lru_cache

# The published suffix tables, longest match first within a step.
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
]
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


def _shape(word: str) -> str:
    """The word as a string of ``v`` (vowel) and ``c`` (consonant)."""
    shape = ""
    for i, letter in enumerate(word):
        vowel = letter in "aeiou" or (letter == "y" and i > 0 and shape[-1] == "c")
        shape += "v" if vowel else "c"
    return shape


def _measure(word: str) -> int:
    """Number of vowel-consonant changes."""
    return _shape(word).count("vc")


def _short_end(word: str) -> bool:
    """Ends consonant-vowel-consonant, the last one not w, x or y."""
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _double_end(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _plural(word: str) -> str:
    for suffix, keep in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(suffix):
            return word[: len(word) - len(suffix)] + keep
    return word


def _past(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        root = word[: -len(suffix)]
        if word.endswith(suffix):
            if "v" not in _shape(root):
                return word
            if root.endswith(("at", "bl", "iz")):
                return root + "e"
            if _double_end(root) and root[-1] not in "lsz":
                return root[:-1]
            return root + "e" if _measure(root) == 1 and _short_end(root) else root
    return word


def _replace(word: str, table) -> str:
    suffix = _longest(word, [s for s, _ in table])
    if suffix and _measure(word[: -len(suffix)]) > 0:
        return word[: -len(suffix)] + dict(table)[suffix]
    return word


def _drop(word: str) -> str:
    suffix = _longest(word, STEP_4)
    if suffix:
        root = word[: -len(suffix)]
        if _measure(root) > 1 and (suffix != "ion" or root.endswith(("s", "t"))):
            return root
    return word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        root = word[:-1]
        if _measure(root) > 1 or (_measure(root) == 1 and not _short_end(root)):
            word = root
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


@lru_cache(maxsize=100_000)
def stem(word: str) -> str:
    """Stem of a lower-case word; words of up to three letters stay as they are."""
    if len(word) <= 3:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    return _tidy(_drop(_replace(_replace(word, STEP_2), STEP_3)))
