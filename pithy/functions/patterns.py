"""Fixed patterns and word lists that decide results.

The patterns are Java's (Spark). Those that could run long are possessive.
"""

from __future__ import annotations

# The characters Python's str.split() and str.strip() call white space.
WS_RANGES = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = f"[{WS_RANGES}]"
# The same characters as Java tells them apart fastest: most others fall outside three ranges.
WS_NEAR = r"\x00-\x20\x{85}-\x{a0}\x{1680}-\x{3000}"
WS_JAVA = f"[{WS_NEAR}&&{WS}]"
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Control characters that cleaning turns into spaces.
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
CONTROL_JAVA = rf"[\x00-\x1f\x7f&&{CONTROL}]"

# Two or more line breaks with blanks only between them.
BLANK_LINES = r"(?Ud)\n(?:[^\S\n]*+\n)++"

# Boilerplate that cleaning removes, in this order. Runs of blank lines are
# two line breaks by then, so the first pattern takes one such run, not any number.
# Each pattern carries the flags it needs: one string for Java, one for RE2.
BOILERPLATE = (
    ("imudU", "im", r"^[^\S\n]*+\n?+[^\S\n]*+(share this article|read more|advertisement|sponsored)\s*+[:\-]?+\s*+"),
    ("iudU", "i", r"\bclick here to .*?(\.|$)"),
    ("iudU", "i", r"\bcopyright\s+©.*?(\.|$)"),
)

# Abbreviations whose final dot never ends a sentence.
ABBREVIATIONS = (
    "Mr.", "Mrs.", "Ms.", "Dr.", "Prof.", "Sr.", "Jr.",
    "St.", "U.S.", "U.K.", "e.g.", "i.e.", "etc.", "vs.", "No.",
)

# What may open the next sentence, and the literal that reads as a dot.
SENTENCE_OPENER = r"""[A-Z"'(]"""
DOT_LITERAL = "<<DOT>>"
# Stands between sentences while a text is split; texts that hold it go another way.
MARK = "\x00"

# Phrases and openings that mark a paragraph as page furniture.
CHROME_PHRASES = (
    "subscribe to", "sign up for", "follow us on",
    "share this article", "cookie policy", "privacy policy",
)
CHROME_OPENING = rf"^(by{WS}|copyright|©)"
MIN_PARAGRAPH_WORDS = 8
MIN_ARTICLE_WORDS = 30

# Elements that are dropped with their content. The first hold no markup and
# end at their first end tag, the others may hold one another and themselves.
TEXT_DROPPED = ("script", "style", "noscript", "iframe", "template")
PAGE_RAW = ("script", "style", "noscript", "iframe")
PAGE_NESTED = ("aside", "footer", "header", "nav", "form", "template")
# Parts that a fold over a page's tags collects at once.
FOLD_BLOCK = 256

# What a tag may hold up to its end: quotes count after "=" only. Java alone: possessive
# groups neither backtrack nor recurse, however long the tag.
TAG_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>"""
# A tag, comment end or doctype; a bare "<" followed by a space is text.
TAG = r"<[/!?a-zA-Z]" + TAG_REST

# Entities decoded without leaving the JVM; "&amp;" must stay last.
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"),
    ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&reg;", "®"), ("&middot;", "·"),
    ("&mdash;", "—"), ("&ndash;", "–"), ("&hellip;", "…"),
    ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"),
    ("&euro;", "€"), ("&pound;", "£"), ("&amp;", "&"),
)

# Characters that NFKC leaves alone, alone or next to one another. Text made of
# these only needs no normalisation; the tests check the claim character by character.
NFKC_STABLE = (
    r"\x00-\x7f\xa1-\xa7\xa9\xab-\xae\xb0\xb1\xb6\xb7\xbb\xbf-\xff"
    r"\x{100}-\x{131}\x{134}-\x{13e}\x{141}-\x{148}\x{14a}-\x{17e}"
    r"\x{400}-\x{482}\x{48a}-\x{4ff}"
    r"\x{2013}\x{2014}\x{2018}-\x{201e}\x{2022}\x{20ac}"
    r"\x{3001}-\x{3003}\x{3008}-\x{3011}\x{3041}-\x{3096}\x{30a1}-\x{30fa}"
    r"\x{4e00}-\x{9fa5}"
)

# What separates the words of the sentence weights, and the tokens of the ROUGE scores.
NON_WORD = r"[^\p{L}\p{N}_]+"
NON_SCORE = "[^a-z0-9]+"
