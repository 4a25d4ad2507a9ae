"""Text functions against Python's own string and regex semantics."""

import html
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from pithy.functions import patterns as P
from pithy.functions import text


def run(spark, column, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


#: Articles and their clean form, worked out by hand.
CLEANED = [
    (None, ""), ("", ""), (" \n ", ""), ("  two\t words\n", "two words"), ("bell\x07 and null\x00byte", "bell and null byte"),
    ("ﬂoor ½ ＡＢ", "floor 1⁄2 AB"), ("e\u0301te\u0301", "été"), ("thin\u2009space\u3000wide\u00a0fixed", "thin space wide fixed"),
    ("Sponsored: new shoes", "new shoes"), ("line\n   ADVERTISEMENT - see inside\nlast", "line see inside last"),
    ("not an advertisement here", "not an advertisement here"), ("read more books", "books"), ("advertisements run", "s run"),
    ("\n\n share this article\n\nbody", "body"), ("top\n\n\n\nsponsored\n\nbody", "top body"),
    ("Text. Click here to win a car. Rest", "Text. Rest"), ("Text. CLICK HERE TO win", "Text."), ("go click here to\nnext", "go click here to next"),
    ("unclick here to go. on", "unclick here to go. on"), ("Copyright © 2031 Press. Tail", "Tail"), ("copyright\n©x y", ""),
    ("copyright 2031 stays", "copyright 2031 stays"), ("日本語 Привет – “q”", "日本語 Привет – “q”"),
]


def scanned_sentences(value):
    """Walks the characters: a run of white space ends a sentence if what stands around it says so."""
    out, begin, i = [], 0, 0
    while i < len(value):
        if not value[i].isspace():
            i += 1
            continue
        j = i
        while j < len(value) and value[j].isspace():
            j += 1
        ends = value[i - 1: i] in tuple(".!?") and i > 0 and not any(value[:i].endswith(short) for short in P.ABBREVIATIONS)
        if ends and value[j: j + 1] and value[j] in "ABCDEFGHIJKLMNOPQRSTUVWXYZ\"'(":
            out.append(value[begin:i])
            begin = j
        i = j
    out.append(value[begin:])
    return [x.replace("<<DOT>>", ".").strip() for x in out if x.strip()]


def test_normalize_article(spark):
    assert run(spark, text.normalize_article, [v for v, _ in CLEANED]) == [clean for _, clean in CLEANED]


def test_nfkc_stable_class_holds():
    """Characters the gate lets pass never change, compose or reorder."""
    stable = re.compile("[" + re.sub(r"\\x\{(\w+)\}", lambda m: "\\u%04x" % int(m[1], 16), P.NFKC_STABLE) + "]")
    chars = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and stable.match(chr(c))]
    assert len(chars) > 20_000
    for ch in chars:
        assert unicodedata.normalize("NFKC", ch) == ch and unicodedata.combining(ch) == 0
        assert unicodedata.normalize("NFKC", "a" + ch) == "a" + ch
    joined = "".join(chars)
    assert unicodedata.normalize("NFKC", joined) == joined


def test_split_sentences(spark):
    cases = [
        ("", []), ("  ", []), ("no end", ["no end"]), ("Rain fell. Mr. Ode left. It cleared", ["Rain fell.", "Mr. Ode left.", "It cleared"]),
        ("Up 3.5 percent! (Really?) 'Yes.' done", ["Up 3.5 percent!", "(Really?) 'Yes.' done"]), ("a. b. C.  D", ["a. b.", "C.", "D"]),
        ("In the U.K. Prices rose. etc. More", ["In the U.K. Prices rose. etc. More"]), ("x<<DOT>> Y. Z", ["x. Y.", "Z"]),
    ]
    assert run(spark, text.split_sentences, [v for v, _ in cases]) == [want for _, want in cases]


def test_sentences_counts_and_cleaning_on_random_text(spark):
    rng = random.Random(11)
    pieces = [*"ab AZ.!?\x00\n\t\"'(\x1c\u00a0é", "<<DOT>>", "Mr.", "U.S.", "etc. ", ". A", "read more", "click here to "]
    values = ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(4000)]
    assert run(spark, text.split_sentences, values) == [scanned_sentences(v) for v in values]
    assert run(spark, text.word_count, values) == [len(v.split()) for v in values]
    assert run(spark, text.strip, values) == [v.strip() for v in values]


def test_blank_lines_before_boilerplate_do_not_matter(spark):
    """The linear pattern gives what one that also takes the blank lines before its line gives."""
    rng = random.Random(12)
    pieces = ["\n", "\n", " ", "\t", "read more", "Sponsored", ":", "-", "a", ".", "click here to ", "share this article"]
    values = ["".join(rng.choices(pieces, k=rng.randint(0, 25))) for _ in range(3000)]
    slow = [r"(?im)^\s*(share this article|read more|advertisement|sponsored)\s*[:\-]?\s*",
            r"(?i)\bclick here to .*?(\.|$)", r"(?i)\bcopyright\s+©.*?(\.|$)"]

    def cleaned(value):
        for pattern in slow:
            value = re.sub(pattern, "", value)
        return " ".join(value.split())

    assert run(spark, text.normalize_article, values) == [cleaned(v) for v in values]


def test_white_space_is_pythons(spark):
    values = [f"a{chr(c)}b" for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    assert run(spark, text.word_count, values) == [len(v.split()) for v in values]
    assert {c for c in map(chr, range(0x110000)) if c.isspace()} == set(P.WS_CHARS)


def test_clean_cell(spark):
    assert run(spark, text.clean_cell, [None, "  x ", "\u3000y\n", "NA"]) == ["", "x", "y", "NA"]


@pytest.mark.parametrize(("value", "expected"), [
    (None, ""), ("a &amp; b", "a &amp; b"), ("<div>Tea <script>run()</script><i>time</i></div>", "Tea time"),
    ("<div>Old <i>mill</i> &mdash; closed</div>", "Old mill — closed"), ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("<p>one</p>\n<p>and two</p>", "one and two"), ("a<br/>b", "a b"),
    ("<!-- hidden <p>x</p> --><p>seen</p>", "seen"), ("<STYLE a='b'>p{}</STYLE ><i>t</i>", "t"),
    ("<p>&amp;lt; &#8217;s &Eacute;lan &bogus; &amp</p>", "&lt; ’s Élan &bogus; &"), ("<p>x</p><script>never closed", "x"),
    ("<p> keep\ninner  space </p>", "keep\ninner  space"),
])
def test_strip_html(spark, value, expected):
    assert run(spark, text.strip_html, [value]) == [expected]


def test_known_entities_are_pythons():
    for name, value in P.ENTITIES:
        assert html.unescape(name) == value


def test_domain(spark):
    urls = ["https://User:pw@News.Example.com:8080/a?b#c", "http://a.b", "//c.d/x", "no scheme", "", None, "ftp://e.f?x"]
    assert run(spark, text.domain, urls) == ["user:pw@news.example.com:8080", "a.b", "c.d", "", "", "", "e.f"]


def test_tokens(spark):
    assert run(spark, text.score_tokens, ["It's 3.5% Élan-x!", ""]) == [["it", "s", "3", "5", "lan", "x"], []]
    assert run(spark, lambda c: text.weight_tokens(c, ("the",)), ["The a_b x Élan 42", "the"]) == [["a_b", "élan", "42"], []]


def test_quick_classes_hold_the_same_characters(spark):
    """The classes written for Java's matcher, over all of the basic plane, and no word begin looked for at every character."""
    chars = spark.range(1, 0x10000).where("id < 55296 or id > 57343").selectExpr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE') as c")
    for quick, known in ((P.WS_JAVA, P.WS), (P.CONTROL_JAVA, P.CONTROL)):
        assert chars.where(F.col("c").rlike(quick) != F.col("c").rlike(known)).count() == 0
    df = spark.createDataFrame([("Click here to go. Stay",), ("Aclick here to go. Stay",), ("x COPYRIGHT © me. Stay",), ("éclick here to go. x",)], "t string")
    made = df.select(text.drop_boilerplate(F.col("t")).alias("t"))
    assert [r.t for r in made.collect()] == [" Stay", "Aclick here to go. Stay", "x  Stay", "éclick here to go. x"]
    assert r"\bclick" not in made._jdf.queryExecution().executedPlan().toString()


def test_has_words(spark):
    texts = ["", " ", "a", " a", "a ", " a  b ", "a b c", " a\nb"]
    found = run(spark, lambda c: F.array(*[text.has_words(c, F.lit(n)) for n in range(5)]), texts)
    assert found == [[len(t.split()) >= n for n in range(5)] for t in texts]


def test_copyright_notices_go_only_where_the_sign_is(spark):
    texts = ["A. COPYRIGHT © 2020 by x. B", "copyright (c) y. B", "© copyright z", "copyright\n©", None]
    assert run(spark, text.drop_boilerplate, texts) == ["A.  B", "copyright (c) y. B", "© copyright z", "", None]
