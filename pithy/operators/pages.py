"""Article extraction from web pages: title, body, domain, length gate.

Regular expressions over the raw markup, no parser: every page is one row and
stays in the JVM unless it holds a rare entity or unusual characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pithy.functions import patterns as P
from pithy.functions import text
from pithy.functions.arrays import bind, compute_once


def _region(markup: Column, name: str) -> Column:
    """Content of the first element of a name, up to its end tag or the end; '' if absent."""
    return F.regexp_extract(markup, rf"(?is)<{name}\b{P.TAG_REST}(.*?)(?:</{name}\s*+>|\z)", 1)


def _has(markup: Column, name: str) -> Column:
    return markup.rlike(rf"(?i)<{name}\b")


def _paragraphs(region: Column) -> Column:
    """Raw content of every <p>: up to its end tag, or the tag that implicitly closes it."""
    chunks = F.split(region, rf"(?i)<p(?=[\s/>]){P.TAG_REST}")
    closers = "p|div|article|section|main|body|html|ul|ol|table|h[1-6]|blockquote|pre|figure"
    return F.transform(
        F.slice(chunks, F.lit(2), F.greatest(F.size(chunks) - 1, F.lit(0))),
        lambda c: F.regexp_extract(c, rf"(?is)^(.*?)(?:</?(?:{closers})\b|\z)", 1),
    )


def looks_like_chrome(paragraph: Column) -> Column:
    """Page furniture: subscription and sharing prompts, bylines, copyright lines."""
    lowered = F.lower(paragraph)
    return lowered.rlike("|".join(P.CHROME_PHRASES)) | lowered.rlike(P.CHROME_OPENING)


def extract_title(markup: Column) -> Column:
    """og:title, else <title>, else the first <h1>, else ''."""
    quoted = r"""\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    meta = F.regexp_extract(markup, r"""(?is)<meta\b[^>]*\bproperty\s*=\s*["']og:title["'][^>]*>""", 0)
    content = F.concat(*(F.regexp_extract(meta, rf"(?is)\bcontent{quoted}", g) for g in (1, 2)))
    title = _region(markup, "title")
    heading = _region(markup, "h1")
    raw = (
        F.when(content != "", content)
        .when((title != "") & ~title.rlike(P.TAG), title)
        .otherwise(heading)
    )
    return text.tags_to_text(raw)


def content_region(markup: Column) -> Column:
    """The first <article> if it has paragraphs, else the first <main>, else the body.

    Articles inside an article belong to it.
    """
    fallback = (
        F.when(_has(markup, "main"), text.first_element(markup, "main"))
        .when(_has(markup, "body"), _region(markup, "body"))
        .otherwise(markup)
    )
    return bind(
        text.first_element(markup, "article"), lambda found: F.when(found.rlike(r"(?i)<p[\s>/]"), found).otherwise(fallback)
    )


def extract_body(region: Column) -> Column:
    """Paragraphs of eight words or more that are no page furniture.

    Paragraph texts are cleaned together: U+0001 keeps them apart meanwhile.
    """
    joined = text.tags_to_text(F.array_join(_paragraphs(region), " <p>\x01</p> "))
    paragraphs = F.transform(F.split(joined, "\x01"), text.strip)
    kept = F.filter(
        paragraphs,
        lambda p: (text.word_count(p) >= P.MIN_PARAGRAPH_WORDS) & ~looks_like_chrome(p),
    )
    return F.array_join(kept, " ")


def parse_pages(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Add `title`, `article`, `domain` and `status` ('ok' or 'too_short'); drop the markup."""
    markup = F.regexp_replace(F.coalesce(F.col(html_col), F.lit("")), "\x01", " ")
    short = text.word_count(F.col("article")) < P.MIN_ARTICLE_WORDS
    pages = compute_once(pages, {"_raw": text.drop_elements(markup, P.PAGE_RAW)}).drop(html_col)
    pages = compute_once(pages, {"_markup": text.drop_nested(F.col("_raw"), P.PAGE_NESTED)}).drop("_raw")
    pages = compute_once(pages, {"_region": content_region(F.col("_markup"))})
    pages = compute_once(pages, {
        "title": extract_title(F.col("_markup")), "_body": extract_body(F.col("_region")),
    }).drop("_markup", "_region")
    pages = compute_once(pages, {"article": text.normalize_article(F.col("_body"))}).drop("_body")
    return pages.withColumns({
        "domain": text.domain(F.col(url_col)),
        "status": F.when(short, "too_short").otherwise("ok"),
    })
