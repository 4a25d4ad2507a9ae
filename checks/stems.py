"""Porter stemming of a vocabulary in SQL, one CTE per step of the published algorithm.

Every step reads (o, w): the token and its form so far. `s` is the form's shape, a
letter v or c per character; a "y" is a vowel after a consonant.
"""

from __future__ import annotations

#: Words with a stem of their own, and the endings of each step in matching order.
OWN = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
DERIVED = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"), ("alli", "al"),
    ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"),
    ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)
ADJECTIVAL = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
REMOVED_BEFORE_ION = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent")
REMOVED_AFTER_ION = ("ou", "ism", "ate", "iti", "ous", "ive", "ize")


def shape(word: str) -> str:
    x = f"regexp_replace(regexp_replace({word}, '[^aeiouy]', 'c', 'g'), '[aeiou]', 'v', 'g')"
    x = f"regexp_replace({x}, '^y', 'c')"
    for _ in range(8):  # a run of "y" resolves from its left
        x = f"replace(replace({x}, 'cy', 'cv'), 'vy', 'vc')"
    return x


def stem(cut: int) -> str:
    return f"w[1:length(w) - {cut}]"


def measure(cut: int) -> str:
    part = f"s[1:length(w) - {cut}]"
    return f"((length({part}) - length(replace({part}, 'vc', ''))) // 2)"


def short_end(cut: int) -> str:
    part = f"s[1:length(w) - {cut}]"
    return f"({part} = 'vc' OR ({part} LIKE '%cvc' AND {stem(cut)}[-1] NOT IN ('w', 'x', 'y')))"


def cases(rules) -> str:
    """rules: (ending, replacement, condition or None); the first ending that fits decides."""
    return "CASE " + " ".join(
        f"WHEN w LIKE '%{e}' THEN " + (f"{stem(len(e))} || '{r}'" if c is None else f"CASE WHEN {c} THEN {stem(len(e))} || '{r}' ELSE w END")
        for e, r, c in rules
    ) + " ELSE w END"


def stems(vocabulary: str) -> str:
    """CTEs up to stems(o, stem); vocabulary(o) holds distinct tokens."""
    some, many = lambda e: f"{measure(len(e))} > 0", lambda e: f"{measure(len(e))} > 1"
    steps = [
        "CASE WHEN w LIKE '%ies' AND length(w) = 4 THEN w[1:3] ELSE "
        + cases((("sses", "ss", None), ("ies", "i", None), ("ss", "ss", None), ("s", "", None))) + " END",
        f"""CASE WHEN w LIKE '%ied' THEN CASE WHEN length(w) = 4 THEN {stem(1)} ELSE {stem(2)} END
            WHEN w LIKE '%eed' THEN CASE WHEN {measure(3)} > 0 THEN {stem(1)} ELSE w END
            WHEN w LIKE '%ed' AND contains(s[1:length(w) - 2], 'v') THEN {stem(2)} || chr(1)
            WHEN w LIKE '%ing' AND contains(s[1:length(w) - 3], 'v') THEN {stem(3)} || chr(1) ELSE w END""",
        # chr(1) marks forms that lost an ending; the shape of what stands before it is unchanged.
        f"""CASE WHEN w NOT LIKE '%' || chr(1) THEN w
            WHEN regexp_matches({stem(1)}, '(at|bl|iz)$') THEN {stem(1)} || 'e'
            WHEN length(w) > 2 AND w[-2] = w[-3] AND s[length(w) - 1] = 'c'
              THEN CASE WHEN w[-2] IN ('l', 's', 'z') THEN {stem(1)} ELSE {stem(2)} END
            WHEN {measure(1)} = 1 AND {short_end(1)} THEN {stem(1)} || 'e' ELSE {stem(1)} END""",
        f"CASE WHEN w LIKE '%y' AND length(w) > 2 AND s[length(w) - 1] = 'c' THEN {stem(1)} || 'i' ELSE w END",
        f"CASE WHEN w LIKE '%alli' AND {measure(4)} > 0 THEN {stem(2)} ELSE w END",
        cases([(e, r, some(e)) for e, r in DERIVED] + [("logi", "log", f"{measure(3)} > 0")]),
        cases([(e, r, some(e)) for e, r in ADJECTIVAL]),
        cases([(e, "", many(e)) for e in REMOVED_BEFORE_ION] + [("ion", "", f"{measure(3)} > 1 AND {stem(3)}[-1] IN ('s', 't')")]
              + [(e, "", many(e)) for e in REMOVED_AFTER_ION]),
        f"CASE WHEN w LIKE '%e' AND ({measure(1)} > 1 OR ({measure(1)} > 0 AND NOT {short_end(1)})) THEN {stem(1)} ELSE w END",
        f"CASE WHEN w LIKE '%ll' AND {measure(1)} > 1 THEN {stem(1)} ELSE w END",
    ]
    ctes, last = [], f"(SELECT o, o AS w FROM {vocabulary})"
    for i, step in enumerate(steps):
        ctes.append(f"stem_{i} AS MATERIALIZED (SELECT o, {step} AS w FROM (SELECT *, {shape('w')} AS s FROM {last}))")
        last = f"stem_{i}"
    own = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in OWN.items())
    ctes.append(f"stems AS MATERIALIZED (SELECT o, CASE o {own} ELSE CASE WHEN length(o) <= 3 THEN o ELSE w END END AS stem FROM {last})")
    return ",\n".join(ctes)
