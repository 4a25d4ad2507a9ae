"""Summarisers as DataFrame transforms: lead-n, TextRank, user-supplied models."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pithy.functions import arrow_udfs, text
from pithy.functions.arrays import compute_once, stopwatch, top_in_order
from pithy.functions.arrow_udfs import within_tokens
from pithy.functions.stopwords import ENGLISH
from pithy.session import small_batches

DAMPING, TOLERANCE, MAX_ITERATIONS = 0.85, 1e-4, 200


def effective_n(requested: int, total: Column, max_ratio: float = 0.6) -> Column:
    """How many sentences a summary may have: fewer than the text, at most 60 %."""
    by_ratio = F.greatest(F.lit(1), F.round(total * F.lit(max_ratio)).cast("int"))
    return F.when(total <= 1, 1).otherwise(
        F.greatest(F.lit(1), F.least(F.lit(requested), by_ratio, total - 1))
    )


def short_input(sentences: Column) -> Column:
    """True where extractive methods have too little to choose from."""
    return F.size(sentences) <= 2


def lead_n(sentences: Column, n: int = 3) -> Column:
    """The first sentences of a text."""
    return text.join_sentences(F.slice(sentences, F.lit(1), effective_n(n, F.size(sentences))))


def sentence_scores(
    sentences: Column, stop_words: Sequence[str] = ENGLISH, *, damping: float = DAMPING,
    tol: float = TOLERANCE, max_iter: int = MAX_ITERATIONS,
) -> Column:
    """PageRank score per sentence over the TF-IDF cosine graph of its own text.

    Null for texts of fewer than two sentences, which have nothing to rank. Row
    local: the plan gets no shuffle, and repeated ids or copies do no harm.
    """
    return arrow_udfs.sentence_ranks(ranked_tokens(sentences, stop_words), damping, tol, max_iter)


def ranked_tokens(sentences: Column, stop_words: Sequence[str] = ENGLISH) -> Column:
    """The weight tokens of every sentence; null for texts of fewer than two sentences."""
    tokens = F.transform(sentences, lambda s: text.weight_tokens(s, tuple(stop_words)))
    return F.when(F.size(sentences) > 1, tokens)


def textrank(sentences: Column, n: int = 3, stop_words: Sequence[str] = ENGLISH) -> Column:
    """The sentences most central to the text, in text order."""
    return best_sentences(sentences, sentence_scores(sentences, stop_words), n)


def timed_textrank(df: DataFrame, n: int, summary: str, seconds: str) -> DataFrame:
    """`df` with TextRank summaries of its `sentences`, and the seconds of all their steps."""
    df = stopwatch(df, {"_tokens": ranked_tokens(F.col("sentences"))}, "_tokens_seconds")
    ranks = arrow_udfs.timed_sentence_ranks(F.col("_tokens"), DAMPING, TOLERANCE, MAX_ITERATIONS)
    df = compute_once(df, {"_ranks": ranks}).drop("_tokens")
    df = stopwatch(df, {summary: best_sentences(F.col("sentences"), F.col("_ranks.scores"), n)}, "_pick_seconds")
    steps = F.col("_tokens_seconds") + F.col("_ranks.seconds") + F.col("_pick_seconds")
    return df.withColumn(seconds, steps).drop("_tokens_seconds", "_ranks", "_pick_seconds")


def best_sentences(sentences: Column, scores: Column, n: int) -> Column:
    """The n best of the sentences in text order; a text of one sentence is its own summary."""
    total = F.size(sentences)
    picked = top_in_order(scores, effective_n(n, total))
    chosen = F.transform(picked, lambda i: F.get(sentences, i))
    return text.join_sentences(F.when(total > 1, chosen).otherwise(sentences))


def model_summary(
    article: Column, load: Callable[[], object],
    predict: Callable[[object, list[str]], list[str]], batch_size: int = 16,
    tokenizer: Callable[[], object] | None = None, max_input_tokens: int | None = None, max_summary_tokens: int | None = None,
) -> Column:
    """(summary, seconds) from a model the user brings, loaded once per task.

    `load` returns the model; `predict` maps a list of articles to summaries. Blank
    articles are never sent. `tokenizer` is a function too, called once per task; with it articles and
    summaries keep within their token budgets, without it `predict` owns them. The
    seconds are each article's share of its call, cutting included, loading left out.
    """

    @F.pandas_udf("summary string, seconds double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, tokens = load(), tokenizer() if tokenizer else None
        for articles in batches:
            wanted = articles[articles.notna()]
            out = pd.DataFrame({"summary": "", "seconds": 0.0}, index=articles.index)
            for at in range(0, len(wanted), batch_size):
                part = wanted.iloc[at : at + batch_size]
                begin = time.perf_counter()
                made = predict(model, within_tokens(part.tolist(), tokens, max_input_tokens))
                made = within_tokens(made, tokens, max_summary_tokens)
                out.loc[part.index, "seconds"] = (time.perf_counter() - begin) / len(part)
                out.loc[part.index, "summary"] = pd.Series(made, part.index, dtype=object)
            yield out

    return run(F.when(text.strip(article) != "", article))


@dataclass(frozen=True)
class Method:
    """A summariser: builds the summary from the article and its sentences.

    `timed` adds the summary and its seconds to a table with `article` text and `sentences`: (df, article,
    n, summary column, seconds column). A method with Python steps needs one; of others the JVM is timed.
    """

    name: str
    build: Callable[[Column, Column, int], Column]
    extractive: bool = True
    timed: Callable[[DataFrame, Column, int, str, str], DataFrame] | None = None


METHODS = {
    "lead_3": Method("lead_3", lambda article, sentences, n: lead_n(sentences, n)),
    "textrank": Method(
        "textrank", lambda article, sentences, n: textrank(sentences, n),
        timed=lambda df, article, n, summary, seconds: timed_textrank(df, n, summary, seconds),
    ),
}


def model_method(name: str, load, predict, batch_size: int = 16, **budget) -> Method:
    """A method backed by a user-supplied model, for use next to the built-in ones; `budget` as in `model_summary`."""

    def timed(df: DataFrame, article: Column, n: int, summary: str, seconds: str) -> DataFrame:
        df = compute_once(df, {"_model": model_summary(article, load, predict, batch_size, **budget)})
        return df.withColumns({summary: F.col("_model.summary"), seconds: F.col("_model.seconds")}).drop("_model")

    return Method(
        name, lambda article, sentences, n: model_summary(article, load, predict, batch_size, **budget)["summary"], False, timed
    )


def choose_methods(methods: Sequence[str | Method] | None = None) -> list[Method]:
    """Resolve names before any job starts; None means every built-in method."""
    chosen = list(METHODS) if methods is None else list(methods)
    if not chosen:
        raise ValueError("Name at least one method")
    resolved = []
    for method in chosen:
        if isinstance(method, str):
            if method not in METHODS:
                raise ValueError(
                    f"There is no method {method!r}; known ones are {', '.join(METHODS)}"
                )
            method = METHODS[method]
        resolved.append(method)
    return resolved


def add_summaries(
    df: DataFrame, methods: Sequence[str | Method] | None = None, n: int = 3,
    article_col: str = "article", prefix: str = "summary_", timed: bool = False,
) -> DataFrame:
    """One summary column per method; the sentences are split once for all of them.

    With `timed` a column `seconds_<method>` says how long each row's summary took in this very run,
    the splitting of sentences, which the methods share, included for each.
    """
    chosen = choose_methods(methods)
    small_batches(df.sparkSession)
    article = text.strip(F.coalesce(F.col(article_col), F.lit("")))
    if timed:
        df = stopwatch(df, {"sentences": text.split_sentences(article)}, "_split_seconds")
        for m in chosen:
            summary, seconds = f"{prefix}{m.name}", f"seconds_{m.name}"
            if m.timed:
                df = m.timed(df, article, n, summary, seconds)
            else:
                df = stopwatch(df, {summary: m.build(article, F.col("sentences"), n)}, seconds)
            if m.extractive:
                df = df.withColumn(seconds, F.col(seconds) + F.col("_split_seconds"))
        return df.drop("_split_seconds")
    df = compute_once(df, {"sentences": text.split_sentences(article)})
    return df.withColumns(
        {f"{prefix}{m.name}": m.build(article, F.col("sentences"), n) for m in chosen}
    )


def summarize(
    df: DataFrame, method: str | Method, n: int = 3, article_col: str = "article"
) -> DataFrame:
    """Add `method`, `summary` and `short_input` to every article."""
    (chosen,) = choose_methods([method])
    df = add_summaries(df, [chosen], n, article_col, prefix="_summary_")
    warn = short_input(F.col("sentences")) if chosen.extractive else F.lit(False)
    return df.select(
        *[c for c in df.columns if c not in ("sentences", f"_summary_{chosen.name}")],
        F.lit(chosen.name).alias("method"),
        F.col(f"_summary_{chosen.name}").alias("summary"),
        warn.alias("short_input"),
    )
