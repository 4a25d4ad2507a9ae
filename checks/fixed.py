"""The constants of the checking SQL, written out for RE2, so that a wrong one in the package shows."""

# The characters Python's str.split() and str.strip() call white space.
WS_RANGES = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = f"[{WS_RANGES}]"
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Control characters that cleaning turns into spaces.
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"

# Boilerplate that cleaning removes, in this order: flags and pattern.
BOILERPLATE = (
    ("im", r"^\s*(share this article|read more|advertisement|sponsored)\s*[:\-]?\s*"),
    ("i", r"\bclick here to .*?(\.|$)"),
    ("i", r"\bcopyright\s+©.*?(\.|$)"),
)

# Abbreviations whose final dot never ends a sentence.
ABBREVIATIONS = (
    "Mr.", "Mrs.", "Ms.", "Dr.", "Prof.", "Sr.", "Jr.",
    "St.", "U.S.", "U.K.", "e.g.", "i.e.", "etc.", "vs.", "No.",
)

# What may open the next sentence, and the literal that reads as a dot.
SENTENCE_OPENER = r"""[A-Z"'(]"""
DOT_LITERAL = "<<DOT>>"

# Phrases and openings that mark a paragraph as page furniture.
CHROME_PHRASES = (
    "subscribe to", "sign up for", "follow us on",
    "share this article", "cookie policy", "privacy policy",
)
CHROME_OPENING = rf"^(by{WS}|copyright|©)"
MIN_PARAGRAPH_WORDS = 8
MIN_ARTICLE_WORDS = 30

# Elements that are dropped with their content.
PAGE_DROPPED = (
    "script", "style", "noscript", "iframe", "aside", "footer", "header", "nav", "form",
    "template",
)
TEXT_DROPPED = ("script", "style", "noscript", "iframe", "template")

# Fixed value: a tag, comment end or doctype.
TAG = r"<[/!?a-zA-Z][^>]*>"

# Entities decoded without leaving the JVM; "&amp;" must stay last.
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"),
    ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&reg;", "®"), ("&middot;", "·"),
    ("&mdash;", "—"), ("&ndash;", "–"), ("&hellip;", "…"),
    ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"),
    ("&euro;", "€"), ("&pound;", "£"), ("&amp;", "&"),
)

# What a delimited file may write for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
