"""Porter stemmer (Porter 1980) with the extensions that ROUGE scoring relies on.

Every step is a table of (ending, replacement, condition on the stem). The first
ending that fits decides the step, whether or not its condition holds.
"""

from __future__ import annotations

# Words with a stem of their own.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning",
    "outings": "outing", "outing": "outing", "cannings": "canning", "canning": "canning",
    "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}


def _shape(word: str) -> str:
    """One letter per character: c for consonants, v for vowels."""
    shape = ""
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and shape[-1:] == "c")
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _some(stem: str) -> bool:
    return _measure(stem) > 0


def _many(stem: str) -> bool:
    return _measure(stem) > 1


def _short_end(stem: str) -> bool:
    """Ends consonant-vowel-consonant (last not w, x, y), or is vowel-consonant."""
    shape = _shape(stem)
    return shape == "vc" or (shape.endswith("cvc") and stem[-1] not in "wxy")


# Endings of the steps, in matching order.
PLURALS = (("sses", "ss", None), ("ies", "i", None), ("ss", "ss", None), ("s", "", None))
DERIVED = tuple(
    (old, new, _some)
    for old, new in (
        ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
        ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
        ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
        ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
        ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
    )
) + (("logi", "log", lambda stem: _some(stem + "l")),)
ADJECTIVAL = tuple(
    (old, new, _some)
    for old, new in (
        ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
        ("ical", "ic"), ("ful", ""), ("ness", ""),
    )
)
SUFFIXES = tuple(
    (old, "", _many)
    for old in "al ance ence er ic able ible ant ement ment ent".split()
) + (("ion", "", lambda stem: _many(stem) and stem[-1] in "st"),) + tuple(
    (old, "", _many) for old in "ou ism ate iti ous ive ize".split()
)
FINAL_L = (("ll", "l", lambda stem: _many(stem + "l")),)


def _apply(word: str, rules) -> str:
    for ending, replacement, condition in rules:
        if word.endswith(ending):
            stem = word[: len(word) - len(ending)]
            return stem + replacement if condition is None or condition(stem) else word
    return word


def _past_and_progressive(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _some(word[:-3]) else word
    for ending in ("ed", "ing"):
        stem = word[: -len(ending)]
        if word.endswith(ending) and "v" in _shape(stem):
            break
    else:
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if stem[-2:-1] == stem[-1] and _shape(stem)[-1] == "c":
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem


def _derivations(word: str) -> str:
    if word.endswith("alli") and _some(word[:-4]):
        word = word[:-2]
    return _apply(word, DERIVED)


def _final_e(word: str) -> str:
    stem = word[:-1]
    if word.endswith("e") and (_many(stem) or (_some(stem) and not _short_end(stem))):
        return stem
    return word


def porter_stem(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = word[:-1] if word.endswith("ies") and len(word) == 4 else _apply(word, PLURALS)
    word = _past_and_progressive(word)
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        word = word[:-1] + "i"
    word = _derivations(word)
    word = _apply(_apply(word, ADJECTIVAL), SUFFIXES)
    return _apply(_final_e(word), FINAL_L)
