import random
import re
import time

import pytest
from pyspark.sql import functions as F

from pithy.functions import text
from pithy.operators.pages import looks_like_chrome, parse_pages

LONG = " ".join(f"word{i}" for i in range(16)) + "."


def parse(spark, *html, url="https://News.example.com/a"):
    df = spark.createDataFrame([(i, url, h) for i, h in enumerate(html)], "page_id long, url string, html string")
    return parse_pages(df).orderBy("page_id").collect()


def test_article_region_and_filters(spark):
    page = f"""<html><head><title>The &amp; Title</title><script>var t="</p>";</script></head><body>
      <nav><p>{LONG}</p></nav><header><h1>Gone</h1></header><!-- <p>{LONG}</p> -->
      <article><h1>Heading</h1><p>{LONG}<p><b>Second</b> {LONG}</p><p>too short</p>
      <p>Subscribe to our letter for more stories like this one today.</p>
      <p>By Some Author, who writes about many things for this paper.</p>
      <form><p>{LONG} form</p></form><aside>{LONG}</aside></article><p>outside {LONG}</p>
      <footer><p>{LONG}</p></footer></body></html>"""
    (row,) = parse(spark, page)
    assert row["title"] == "The & Title" and row["domain"] == "news.example.com" and row["status"] == "ok"
    assert row["article"] == f"{LONG} Second {LONG}"
    assert "html" not in row.asDict()


@pytest.mark.parametrize("page", [
    f"<body><article>no paragraphs</article><main><p>{LONG}</p><p>{LONG}</p></main><p>not {LONG}</p></body>",
    f"<body><p>{LONG}</p><div><p>{LONG}</div></body>", f"<p>{LONG}</p><p>{LONG}", f"<BODY><P class='x'>{LONG}<P>{LONG}</BODY>",
    f"<article><p>{LONG}<p>{LONG}<footer><p>{LONG} unclosed footer",
])
def test_fallback_regions(spark, page):
    (row,) = parse(spark, page)
    assert row["article"] == f"{LONG} {LONG}" and row["status"] == "ok"


def test_titles(spark):
    rows = parse(
        spark,
        '<meta property="og:title" content=" Og &quot;T&quot; "><title>T</title>',
        "<meta content='Other order' property='og:title'><title>T</title>",
        '<meta property="og:title" content=""><title> Plain </title>', "<title></title><h1>An <i>inner</i> h1</h1>",
        "<header><h1>gone</h1></header><body></body>", "<title> </title><h1>x</h1>", None,
    )
    assert [r["title"] for r in rows] == ['Og "T"', "Other order", "Plain", "An inner h1", "", "", ""]
    assert {r["status"] for r in rows} == {"too_short"}


def test_thirty_word_gate(spark):
    p29, p30 = (" ".join(f"w{i}" for i in range(n)) for n in (29, 30))
    rows = parse(spark, f"<p>{p29}</p>", f"<p>{p30}</p>")
    assert [r["status"] for r in rows] == ["too_short", "ok"]


def test_chrome(spark):
    cases = {"By Jane": True, "byline": False, "COPYRIGHT 2020": True, "© x": True, "see our Cookie Policy": True,
             "Follow us on the map": True, "a copyright case": False, "stand by me": False}
    df = spark.createDataFrame(list(cases.items()), "p string, want boolean")
    assert df.where(looks_like_chrome(F.col("p")) != F.col("want")).count() == 0


def test_long_runs_of_markup_are_linear(spark):
    """Neither stack nor time grows out of bounds; the input is no literal, so an executor works on it."""
    n = 100_000
    cases = [("<br>\n", n), ("<td></td>", n), (" ", 1_000_000), ("\n", 1_000_000), ("<p>", n), ("<!---->", n)]
    for piece, times in cases:
        df = spark.range(1).selectExpr(f"concat('<p>start', repeat('{piece}', cast(id as int) + {times}), 'end</p>') as html", "'u' as url")
        begin = time.perf_counter()
        (row,) = df.select(text.strip_html(F.col("html")).alias("t"), text.normalize_article(F.col("html")).alias("a")).collect()
        parse_pages(df).collect()
        assert row["t"].split() == ["start", "end"] or "start" in row["t"]
        assert time.perf_counter() - begin < 15, piece


@pytest.mark.parametrize("markup, visible", [
    ('<a title="x > y" href="u">Link</a> end', "Link end"), ("<a title='>'>a</a><b>c</b>", "a c"),
    ('<p class=a">one</p><p>two "quoted" words</p>', 'one two "quoted" words'), ("a<template><b>hidden</b></template>b <i>c</i>", "a b c"),
    ("<br>" * 50 + "x", "x"), ("1 < 2 <b>bold</b>", "1 < 2 bold"),
])
def test_visible_text(spark, markup, visible):
    df = spark.createDataFrame([(markup,)], "html string")
    assert df.select(text.strip_html(F.col("html"))).first()[0] == visible


# --- nested elements and old entities ---

INNER = " ".join(f"inner{i}" for i in range(16)) + "."


@pytest.mark.parametrize("page, article", [
    (f"<article><p>{LONG}</p><article><p>{INNER}</p></article><p>{LONG}</p></article><p>after {LONG}</p>", f"{LONG} {INNER} {LONG}"),
    (f"<aside><aside><p>{INNER}</p></aside><p>leak {INNER}</p></aside><p>{LONG}</p><p>{LONG}</p>", f"{LONG} {LONG}"),
    (f"<nav><form><nav>x</nav><p>{INNER}</p></form><p>{INNER}</p></NAV><p>{LONG}</p></aside></nav><p>{LONG}</p>", f"{LONG} {LONG}"),
    (f"<main><div><main><p>{LONG}</p></main></div><p>{INNER}</p></main><p>{INNER} out</p>", f"{LONG} {INNER}"),
    (f"<header><script>var a = '<header>';</script><p>{INNER}</p></header><p>{LONG}</p><p>{LONG}", f"{LONG} {LONG}"),
    (f"<navy><p>{LONG}</p></navy><p>{LONG}</p><nav ><p>{INNER}</p>", f"{LONG} {LONG}"),
    (f"<article/><p>{LONG}</p><p>{LONG}</p></article>{INNER}", f"{LONG} {LONG}"),
])
def test_nested_elements_end_at_their_own_tag(spark, page, article):
    (row,) = parse(spark, page)
    assert row["article"] == article


def plain_drop(tokens, names):
    """Brute force over (tag or text) tokens: what is outside of the outermost dropped elements."""
    out, open_ = [], []
    for token in tokens:
        name = token.strip("</>")
        if token.startswith("</") and name in names:
            if open_ and open_[0] == name:
                open_.pop()
        elif token.startswith("<") and name in names:
            if not open_ or open_[0] == name:
                open_.append(name)
        elif not open_ and not token.startswith("<"):
            out.append(token)
    return out


def test_dropped_elements_equal_a_counting_loop(spark):
    random.seed(3)
    pool = ["<nav>", "</nav>", "<aside>", "</aside>", "<b>", "</b>"]
    pages = [[random.choice(pool) if random.random() < 0.6 else f"t{i}" for i in range(random.choice([3, 30, 700]))] for _ in range(60)]
    df = spark.createDataFrame([(i, "".join(p)) for i, p in enumerate(pages)], "id long, html string")
    got = {r.id: r.t for r in df.select("id", text.drop_nested(F.col("html"), ("aside", "nav")).alias("t")).collect()}
    for i, p in enumerate(pages):
        assert re.sub("<[^>]*>", "", got[i]) == "".join(plain_drop(p, {"nav", "aside"}))


def test_nested_elements_are_linear(spark):
    for opening, closing in (("<aside>", "</aside>"), ("<article>", "</article>"), ("<nav>x</nav>", "")):
        df = spark.range(1).selectExpr(
            f"concat(repeat('{opening}', 50000 + cast(id as int)), 'in', repeat('{closing}', 50000), '<p>end</p>') as html", "'u' as url")
        begin = time.perf_counter()
        parse_pages(df).collect()
        assert time.perf_counter() - begin < 15


@pytest.mark.parametrize("markup, visible", [
    ("caf&eacute<br>&copy 2030", "café © 2030"), ("&notit; &not; &amplt; AT&T R&D &copyx", "¬it; ¬ &lt; AT&T R&D ©x"), ("&#233 &#xe9; &#x", "é é &#x"),
    ("&amp;eacute &amp &lt", "&eacute & <"), ("&unknown; &eacute;&Eacute", "&unknown; éÉ"),
])
def test_entities_without_semicolon(spark, markup, visible):
    df = spark.createDataFrame([(f"<p>{markup}</p>",)], "html string")
    assert df.select(text.strip_html(F.col("html"))).first()[0] == visible
