"""Main text of web pages by composite text density."""

from __future__ import annotations

import html as html_text
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pithy.llm.common import small_batches

#: Fixed values of HTML: elements without content, whose content is no markup, that break no line,
#: and that end an open paragraph or an open element of their own kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr "
    "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub "
    "msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
SPACED = frozenset("br mtd mtr".split())
OWN_KIND = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
HOLDERS = frozenset("ul ol dl table select div article section main body".split())

#: Elements that are never part of an article, and class, id and role names (whole ones) that lower an element's
#: standing. Markup of formulas is text but for its second form in <annotation>.
DROPPED = frozenset(
    "nav header footer aside form script style noscript template textarea title iframe svg annotation annotation-xml canvas audio video object "
    "button select option datalist dialog menu head xmp noembed noframes".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense sponsor sponsored promo promotion menu menubar nav navbar "
    "navigation breadcrumb breadcrumbs header masthead footer sidebar aside complementary cookie cookies consent notice notices "
    "gdpr banner popup modal dialog overlay newsletter subscribe subscription signup login search comment comments commentlist "
    "disqus reply replies respond responses discussion related recommended share sharing social pagination pager toolbar widget contentinfo "
    "alert hidden "
    "ad-banner ad-block ad-box ad-container ad-slot ad-unit ad-wrapper banner-ad google-ad side-ad top-ad sponsored-content "
    "sponsored-links promo-box menu-bar main-menu mobile-menu nav-menu side-menu site-menu top-menu nav-bar main-nav site-nav "
    "top-nav main-navigation post-navigation site-navigation breadcrumb-trail site-header site-footer page-footer footer-widgets "
    "side-bar sidebar-widget widget-area cookie-banner cookie-bar cookie-consent cookie-notice consent-banner gdpr-banner "
    "modal-dialog newsletter-form newsletter-signup subscribe-form signup-form login-form search-bar search-box search-form "
    "comment-form comment-list comment-respond comment-section comments-area comments-list comments-section post-comments "
    "related-articles related-content related-links related-posts related-stories recommended-posts share-bar share-buttons "
    "share-links sharing-buttons social-icons social-links social-media social-share alert-box".split()
)
HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|_")
TAG = re.compile(
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+))?+|=)*+)>"""
)
NAMED = re.compile(r"""(?:^|[\s/"'])(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+))?""", re.I)


HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KINDS = frozenset(OWN_KIND).union(*OWN_KIND.values())


def read_attributes(attributes: str) -> tuple[bool, str, bool]:
    """Whether an element's attributes hide it, which one names it a side element ("", "id", "class"), and whether it is the main content.

    Names are compared whole, never words inside them; `topMenu` and `top_menu` are `top-menu`.
    """
    hides, aside, main = False, "", False
    for name, value in NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            hides = True
        elif name == "style":
            hides = hides or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif name == "role" and value.lower() == "main" or name == "itemprop" and value.lower() == "articlebody":
            main = True
        elif name in ("class", "id", "role") and not DROPPED_NAMES.isdisjoint(HUMP.sub("-", value).lower().split()):
            aside = "id" if name == "id" and not aside else "class"
    return hides, aside, main


class Page:
    """The elements of a page as parallel lists, parents before children, and its text pieces in order."""

    def __init__(self, source: str):
        self.names, self.parents, self.main = ["body"], [-1], [False]
        self.hidden, self.aside = [False], [""]  # by element or hiding attribute, with all below; by a name of its own
        self.pieces: list[tuple[int, str]] = []  # (element, text), or (element, " ") where a block or line ends
        self.stack, self.open = [0], Counter({"body": 1})
        self.items: list[dict[str, list[int]]] = [{}]  # per open holder: depths of the open list items, cells and the like in it
        self._read(source)

    def _close(self, depth: int) -> None:
        while len(self.stack) > depth:
            at = self.stack.pop()
            self.open[self.names[at]] -= 1
            if self.names[at] in HOLDERS:
                self.items.pop()
            elif self.names[at] in KINDS:
                self.items[-1][self.names[at]].pop()
            if self.names[at] not in INLINE:
                self.pieces.append((self.stack[-1], " "))

    def _start(self, name: str, attributes: str) -> None:
        if name in ("html", "body"):
            return
        if name == "head":
            attributes = ""
        if name not in INLINE and name != "br":
            if name == "body" or self.open["head"] and name not in RAW and name not in VOID:
                self._close_to({"head"})
            if self.open["p"]:
                depth = len(self.stack) - 1
                while self.names[self.stack[depth]] in INLINE:
                    depth -= 1
                if self.names[self.stack[depth]] == "p":
                    self._close(depth)
            begun = [at[0] for at in (self.items[-1].get(k) for k in OWN_KIND.get(name, ())) if at]
            if begun:
                self._close(min(begun))
            self.pieces.append((self.stack[-1], " "))
        elif name in SPACED:
            self.pieces.append((self.stack[-1], " "))
        if name in VOID:
            return
        hides, aside, main = read_attributes(attributes) if attributes else (False, "", False)
        parent = self.stack[-1]
        self.names.append(name)
        self.parents.append(parent)
        self.hidden.append(self.hidden[parent] or hides or name in DROPPED)
        self.aside.append(aside)
        self.main.append(main or name in ("article", "main"))
        if name in HOLDERS:
            self.items.append({})
        elif name in KINDS:
            self.items[-1].setdefault(name, []).append(len(self.stack))
        self.stack.append(len(self.names) - 1)
        self.open[name] += 1

    def _close_to(self, names: set[str]) -> None:
        if any(self.open[n] for n in names):
            depth = len(self.stack) - 1
            while self.names[self.stack[depth]] not in names:
                depth -= 1
            if depth:
                self._close(depth)

    def _text(self, text: str) -> None:
        if text and not self.hidden[self.stack[-1]]:
            self.pieces.append((self.stack[-1], html_text.unescape(text)))

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            mark = source.find("<", at)
            if mark < 0:
                mark = size
            self._text(source[at:mark])
            if mark >= size:
                break
            if source.startswith("<!--", mark):
                end = source.find("-->", mark + 2)
                at = size if end < 0 else end + 3
                continue
            if source[mark + 1: mark + 2] in ("!", "?"):
                end = source.find(">", mark)
                at = size if end < 0 else end + 1
                continue
            tag = TAG.match(source, mark)
            if tag is None:
                begins = source[mark + 1: mark + 3].lstrip("/")[:1]
                if begins.isascii() and begins.isalpha():  # the page ends inside a tag
                    break
                self._text("<")
                at = mark + 1
                continue
            at, name = tag.end(), tag[2].lower()
            if tag[1]:
                if name == "p" and not self.open["p"] or name == "br":
                    self.pieces.append((self.stack[-1], " "))
                elif name not in ("html", "body"):
                    self._close_to({name})
                continue
            self._start(name, tag[3])
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(source, at)
                if end is None:
                    break
                at = end.start()


class Measure:
    """Densities of a page's elements, without the dropped ones and all below them.

    `density` is the composite text density: characters per tag, the less the more of
    them are links, by the published formula; counts of zero in a divisor stand for
    one. `total` is the sum over the children of a block; its own text and the
    elements inside its lines count like a child. `best_in` is the element of the greatest sum in every
    subtree, the first of equals.
    """

    def __init__(self, page: Page, gone: set[int]):
        count = len(page.names)
        self.dropped = [False] * count
        for at in range(count):
            self.dropped[at] = page.hidden[at] or at in gone or at > 0 and self.dropped[page.parents[at]]
        own, self.tags, self.link_chars, self.links = [0] * count, [0] * count, [0] * count, [0] * count
        for at, text in page.pieces:
            if not self.dropped[at]:
                own[at] += len(" ".join(text.split()))
        self.chars = own[:]
        for at in range(count - 1, 0, -1):
            if self.dropped[at]:
                continue
            up, link = page.parents[at], page.names[at] == "a"
            self.chars[up] += self.chars[at]
            self.tags[up] += self.tags[at] + 1
            self.link_chars[up] += self.chars[at] if link else self.link_chars[at]
            self.links[up] += 1 if link else self.links[at]
            if link:
                self.link_chars[at], self.links[at] = self.chars[at], 1
        self.density = self._densities()
        # block: the block an element's lines belong to; line_*: text and links in a block's own lines.
        self.block, self.total = list(range(count)), [float(own[0])] + [-1.0] * (count - 1)
        self.line_chars, self.line_link_chars, self.line_links = own[:], [0] * count, [0] * count
        for at in range(1, count):
            if self.dropped[at]:
                continue
            up = self.block[page.parents[at]]
            if page.names[at] in INLINE:
                self.block[at] = up
                self.total[up] += own[at]
                self.line_chars[up] += own[at]
                if page.names[at] == "a":
                    self.line_link_chars[up] += self.chars[at]
                    self.line_links[up] += 1
            else:
                self.total[at] = float(own[at])
                self.total[up] += self.density[at]
        self.best_in = list(range(count))
        for at in range(count - 1, 0, -1):
            up, best = page.parents[at], self.best_in[at]
            if not self.dropped[at] and (self.total[best], -best) > (self.total[self.best_in[up]], -self.best_in[up]):
                self.best_in[up] = best

    def _densities(self) -> list[float]:
        body_share = self.link_chars[0] / max(self.chars[0], 1)
        out = []
        for c, t, lc, lt in zip(self.chars, self.tags, self.link_chars, self.links):
            if not c:
                out.append(0.0)
                continue
            t, links, lt = max(t, 1), max(lc, 1), max(lt, 1)
            base = math.log(c / max(c - lc, 1) * links + body_share * c + math.e)
            out.append(c / t * math.log(c / links * t / lt) / math.log(base))
        return out


def marks(page: Page) -> tuple[list[bool], list[int]]:
    """Whether an element is, or holds, a marked article; and the innermost marked element around it or itself, or -1."""
    holds = [main and not hidden for main, hidden in zip(page.main, page.hidden)]
    for at in range(len(holds) - 1, 0, -1):
        if holds[at]:
            holds[page.parents[at]] = True
    within = [-1] * len(holds)
    for at in range(len(holds)):
        within[at] = at if page.main[at] and not page.hidden[at] else within[page.parents[at]] if at else -1
    return holds, within


def measured(page: Page, holds: list[bool], within: list[int]) -> Measure:
    """The page without the side elements that their names and densities tell.

    A name never drops a heading, nor what is or holds a marked article. Inside a marked
    article an id drops nothing, and a class or role only what is less dense than the
    article. Elsewhere a named element goes, unless its best subtree has more than
    twice the sum of the best one without it: then the names around that subtree count for nothing.
    """
    loose = Measure(page, set())
    side = set()
    for at, name in enumerate(page.aside):
        if not name or holds[at] or page.names[at] in HEADINGS:
            continue
        if within[at] < 0 or name == "class" and loose.density[at] < loose.density[within[at]]:
            side.add(at)
    if not side:
        return loose
    strict = Measure(page, side)
    best = loose.best_in[0]
    if 2 * strict.total[strict.best_in[0]] >= loose.total[best]:
        return strict
    while best >= 0:
        side.discard(best)
        best = page.parents[best]
    return Measure(page, side)


def content_roots(page: Page) -> tuple[list[int], list[bool]]:
    """The elements whose text is the article's, and which elements below them are left out.

    The subtree of the greatest sum of child densities is found. Its least density on
    the way to the body is the threshold; other elements of that density add the best
    subtree they hold. A marked article bounds the search: of the marked elements the
    one of the greatest sum counts alone, if that is at least half the page's. Inside
    a root, lists of links below the threshold go.
    """
    holds, within = marks(page)
    m = measured(page, holds, within)
    if not m.chars[0]:
        return [], m.dropped
    best = m.best_in[0]
    scope = within[best]
    if scope < 0 and holds[best]:
        scope = max((at for at in range(len(within)) if within[at] == at and not m.dropped[at]), key=lambda at: m.total[m.best_in[at]], default=-1)
        if scope >= 0 and 2 * m.total[m.best_in[scope]] < m.total[best]:
            scope = -1
    threshold, at = m.density[best], scope if scope >= 0 else best
    while at >= 0:
        threshold = min(threshold, m.density[at])
        at = page.parents[at]
    if scope >= 0:
        roots = [scope]
    else:
        blocks = (i for i in range(len(within)) if m.total[i] >= 0 and m.chars[i])
        roots = sorted({best} | {m.best_in[i] for i in blocks if m.density[i] >= threshold})
    return roots, without_link_lists(page, m, set(roots), threshold)


def without_link_lists(page: Page, m: Measure, roots: set[int], threshold: float) -> list[bool]:
    """What is left out: blocks of three links or more that are mostly links and below the threshold, and such links between blocks."""
    has_blocks = [False] * len(page.names)
    for at in range(1, len(page.names)):
        if not m.dropped[at] and page.names[at] not in INLINE:
            has_blocks[m.block[page.parents[at]]] = True
    out = [False] * len(page.names)
    for at in range(len(page.names)):
        out[at] = m.dropped[at] or at > 0 and out[page.parents[at]]
        if out[at] or at in roots:
            continue
        if page.names[at] == "a":
            up = m.block[at]
            out[at] = has_blocks[up] and m.line_links[up] >= 3 and 2 * m.line_link_chars[up] > m.line_chars[up]
        elif page.names[at] not in INLINE:
            out[at] = m.links[at] >= 3 and 2 * m.link_chars[at] > m.chars[at] and m.density[at] < threshold
    return out


def main_text(source: str | None) -> str:
    """The article of a page: blocks in order, white space collapsed; empty if there is none."""
    if not source:
        return ""
    page = Page(source)
    roots, out = content_roots(page)
    chosen = set(roots)
    inside = [False] * len(page.names)
    for at in range(len(page.names)):
        inside[at] = not out[at] and (at in chosen or at > 0 and inside[page.parents[at]])
    # Blanks between blocks belong to the text whichever element they are noted under.
    return " ".join("".join(text if text == " " or inside[at] else "" for at, text in page.pieces).split())


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """(id_col, url_col, text, n_chars) for every row of `pages`; map-only, whole pages.

    A null or empty page, and one without text outside of menus and the like, gives
    an empty text. Repeated rows give one result row each; nulls in other columns
    stay; extra columns are ignored; an empty table gives an empty result.
    """
    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).cast("string").alias("_html"))
    schema = rows.select(id_col, url_col).schema.add("text", "string").add("n_chars", "long")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.names
            )

    small_batches(pages.sparkSession)
    return rows.mapInArrow(step, schema)
