"""Text cleaning, sentences and counts as column expressions."""

from __future__ import annotations

import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from pithy.functions import arrow_udfs
from pithy.functions import patterns as P
from pithy.functions.arrays import bind


def strip(text: Column) -> Column:
    """Drop white space at both ends."""
    return F.btrim(text, F.lit(P.WS_CHARS))


def clean_cell(value: Column) -> Column:
    """Null becomes the empty string; anything else its stripped text."""
    return strip(F.coalesce(value.cast("string"), F.lit("")))


def word_count(text: Column) -> Column:
    """Number of white-space separated words."""
    return F.size(F.array_remove(F.split(text, f"{P.WS_JAVA}+"), ""))


def has_words(text: Column, n: Column) -> Column:
    """Whether a text has at least n words; looks no further than those."""
    # A blank begin is one part more, and the last part is what was not looked at.
    return F.size(F.array_remove(F.split(text, f"{P.WS_JAVA}+", n + 2), "")) >= n


def collapse_spaces(text: Column) -> Column:
    """Every run of white space becomes one space; the ends are stripped.

    Single plain spaces, the usual case, do not match and are not rewritten.
    """
    # One class first, which letters fail at once: a space is let through where another character follows.
    return F.trim(F.regexp_replace(text, f"{P.WS_JAVA}(?:(?<! ){P.WS_JAVA}*+|{P.WS_JAVA}++)", " "))


def nfkc(text: Column) -> Column:
    """Unicode NFKC; only texts that may change leave the JVM."""
    # ASCII is told apart first, by bytes and by character: the wide class is slow to test on every character.
    wide = F.octet_length(text) > F.length(text)
    unstable = F.when(wide & text.rlike(rf"[\x{{80}}-\x{{10ffff}}&&[^{P.NFKC_STABLE}]]"), text)
    return F.coalesce(arrow_udfs.nfkc(unstable), text)


def drop_boilerplate(text: Column) -> Column:
    text = F.regexp_replace(text, P.BLANK_LINES, "\n\n")
    for java_flags, _, pattern in P.BOILERPLATE:
        # The letter is matched before the word's begin is looked for: most characters fail at once.
        java = f"(?{java_flags})" + re.sub(r"^\\bc", lambda _: r"(?-iu:[cC])(?<=\b.)", pattern)
        # A sign that few texts hold is found by bytes.
        text = _replace_where(text, "©", java) if "©" in pattern else F.regexp_replace(text, java, "")
    return text


def _replace_where(text: Column, sign: str, pattern: str) -> Column:
    """Drop what matches; texts without the sign, which every match holds, are not searched."""
    return bind(text, lambda t: F.when(t.contains(sign), F.regexp_replace(t, pattern, "")).otherwise(t))


def normalize_article(text: Column) -> Column:
    """NFKC, control characters, boilerplate, white space - in this order.

    Case and punctuation stay. Line starts still exist when boilerplate goes.
    """
    text = nfkc(F.coalesce(text.cast("string"), F.lit("")))
    return collapse_spaces(drop_boilerplate(F.regexp_replace(text, P.CONTROL_JAVA, " ")))


def tag_of(names: str) -> str:
    """Where a start or end tag of the names begins."""
    return rf"</?(?:{names})(?=[\s/>])"


def drop_elements(markup: Column, names: tuple[str, ...]) -> Column:
    """Remove comments and the named elements with their content.

    One alternation, so whichever opens first wins; an unclosed element runs to
    the end. Every element ends at its first end tag, which suits those that
    cannot nest; for the others see `drop_nested`.
    """
    elements = "|".join(rf"<{name}\b{P.TAG_REST}.*?(?:</{name}\s*+>|\z)" for name in names)
    return F.regexp_replace(markup, rf"(?is)<!--.*?(?:-->|\z)|{elements}", " ")


def drop_nested(markup: Column, elements: tuple[str, ...]) -> Column:
    """Remove the outermost of the named elements, each up to the end tag that balances it or the end.

    `markup` should be a plain column: Spark cannot evaluate an Arrow UDF over these folds.
    A fold over the parts that begin with such a tag counts the open elements of the
    outermost one's name; other names inside it go with it. Stray end tags change
    nothing. The parts go in blocks, as a fold that collects copies what it holds.
    """
    names = "|".join(elements)
    part = F.transform(F.split(markup, f"(?i)(?={tag_of(names)})", -1), lambda p: F.struct(
        p.alias("text"), F.lower(F.regexp_extract(p, f"(?i)^<({names})(?=[\\s/>])", 1)).alias("opens"),
        F.lower(F.regexp_extract(p, f"(?i)^</({names})(?=[\\s/>])", 1)).alias("closes"),
    ))

    def step(state: Column, p: Column) -> Column:
        depth, name = state["depth"], state["name"]
        now = (
            F.when((p["opens"] != "") & ((depth == 0) | (name == p["opens"])), depth + 1)
            .when((depth > 0) & (name == p["closes"]), depth - 1).otherwise(depth)
        )
        return F.struct(
            now.alias("depth"), F.when((p["opens"] != "") & (depth == 0), p["opens"]).otherwise(name).alias("name"),
            F.concat(state["kept"], F.array(F.when(now == 0, p["text"]))).alias("kept"),
        )

    def block(states: Column, parts: Column) -> Column:
        last = F.element_at(states, -1)
        begin = F.struct(last["depth"].alias("depth"), last["name"].alias("name"), none.alias("kept"))
        return F.concat(states, F.array(F.aggregate(parts, begin, step)))

    none = F.array().cast("array<string>")
    blocks = bind(part, lambda ps: F.transform(
        F.sequence(F.lit(0), F.size(ps) - 1, F.lit(P.FOLD_BLOCK)), lambda at: F.slice(ps, at + 1, F.lit(P.FOLD_BLOCK))
    ))
    start = F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("name"), none.alias("kept")))
    states = F.aggregate(blocks, start, block)
    rest = F.array_join(F.flatten(F.transform(states, lambda s: s["kept"])), "")
    return F.when(markup.rlike(f"(?i){tag_of(names)}"), rest).otherwise(markup)


def first_element(markup: Column, name: str) -> Column:
    """Content of the first element of a name, up to the end tag that balances it or the end; '' if absent."""
    opens, closes = rf"(?i)^<{name}(?=[\s/>])", rf"(?i)^</{name}(?=[\s/>])"

    def step(s: Column, p: Column) -> Column:
        starts, ends = p.rlike(opens), p.rlike(closes)
        over = s["end"] >= 0
        return F.struct(
            (s["at"] + 1).alias("at"), F.when(starts & (s["begin"] < 0), s["at"]).otherwise(s["begin"]).alias("begin"),
            F.when(~over & ends & (s["depth"] == 1), s["at"]).otherwise(s["end"]).alias("end"),
            F.when(over, s["depth"]).when(starts, s["depth"] + 1).when(ends & (s["depth"] > 0), s["depth"] - 1).otherwise(s["depth"]).alias("depth"),
        )

    def content(parts: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit(-1).alias("begin"), F.lit(-1).alias("end"), F.lit(0).alias("depth"))
        return bind(F.aggregate(parts, start, step), lambda s: F.when(s["begin"] < 0, "").otherwise(F.array_join(
            F.slice(parts, s["begin"] + 1, F.when(s["end"] < 0, s["at"]).otherwise(s["end"]) - s["begin"]), "")))

    found = bind(F.split(markup, f"(?i)(?={tag_of(name)})", -1), content)
    return F.regexp_replace(found, rf"(?i)^<{name}(?=[\s/>]){P.TAG_REST}", "")


def tags_to_text(markup: Column) -> Column:
    """Each text node stripped, nodes joined by one space, entities decoded.

    The markup is split at its tags: linear, however many follow one another.
    """
    nodes = F.transform(F.split(markup, P.TAG, -1), strip)
    return decode_entities(F.array_join(F.array_remove(nodes, ""), " "))


def decode_entities(text: Column) -> Column:
    """Decode entities: the usual ones in the JVM, texts with others in an Arrow UDF.

    The old Latin-1 names need no `;`: the longest one that fits counts.
    """
    known = "|".join(name[1:-1] for name, _ in P.ENTITIES)
    bare = "|".join(sorted(name for name in html5 if not name.endswith(";")))
    rare = bind(text, lambda t: F.when(t.rlike(rf"&(?!(?:{known});)(?:#[0-9xX]|\w+;|{bare})"), t))
    usual = text
    for name, value in P.ENTITIES:
        usual = F.replace(usual, F.lit(name), F.lit(value))
    return F.coalesce(arrow_udfs.unescape_entities(rare), usual)


def strip_html(value: Column) -> Column:
    """Visible text of a fragment; text without '<' is returned as it is."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    visible = tags_to_text(drop_elements(text, P.TEXT_DROPPED))
    return F.when(text.contains("<"), visible).otherwise(text)


def split_sentences(text: Column) -> Column:
    """Sentences of a text as an array; empty for blank text.

    Splits at white space between a terminator and a sentence opener, unless the
    terminator closes an abbreviation.
    """
    abbreviation = "|".join(a[:-1].replace(".", r"\.") for a in P.ABBREVIATIONS)
    opener = f"{P.WS_JAVA}++(?={P.SENTENCE_OPENER})"
    boundary = rf"(?<=[.!?])(?<!(?:{abbreviation})\.){opener}"
    # Terminators are found faster when they are matched than when they are looked back at from every character.
    marked = rf"([.!?])(?<!(?:{abbreviation})\.){opener}"

    def split(t: Column) -> Column:
        quick = F.split(F.regexp_replace(t, marked, f"$1{P.MARK}"), P.MARK)
        parts = F.array_remove(F.when(t.contains(P.MARK), F.split(t, boundary)).otherwise(quick), "")
        return bind(parts, lambda p: F.when(t.contains(P.DOT_LITERAL), dots(p)).otherwise(p))

    def dots(parts: Column) -> Column:
        return F.transform(parts, lambda part: F.replace(part, F.lit(P.DOT_LITERAL), F.lit(".")))

    # Sentences begin with an opener and end with a terminator: only the text's own ends need stripping.
    return bind(strip(text), split)


def join_sentences(sentences: Column) -> Column:
    return F.array_join(sentences, " ")


def compression_ratio(summary_words: Column, article_words: Column) -> Column:
    return summary_words / F.greatest(F.lit(1), article_words)


def weight_tokens(sentence: Column, stop_words: tuple[str, ...]) -> Column:
    """Lower-case words of two or more characters, stop words removed."""
    words = F.split(F.lower(sentence), P.NON_WORD)
    return F.filter(words, lambda word: (F.length(word) > 1) & ~word.isin(*stop_words))


def score_tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.array_remove(F.split(F.lower(text), P.NON_SCORE), "")


def domain(url: Column) -> Column:
    """Lower-case network location, user info and port included; '' if there is none."""
    return F.lower(
        F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    )
