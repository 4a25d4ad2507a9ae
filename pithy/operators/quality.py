"""Checks and profiles of article-summary tables.

Validation reads the raw text, before cleaning. The row checks are labels in one
pass; `validate` raises from their aggregate, `quarantine` splits the table.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pithy.functions import patterns as P
from pithy.functions import text
from pithy.functions.arrays import bind, compute_once
from pithy.session import written


class DataValidationError(ValueError):
    """The table cannot support summarisation as configured."""


@dataclass(frozen=True)
class Columns:
    """Names of the columns a corpus uses; id and source may be None."""

    article: str = "article"
    summary: str = "highlights"
    id: str | None = "id"
    source: str | None = "source"


DEFAULT = Columns()

#: Column in which a reader leaves a line that it could not parse.
CORRUPT = "_corrupt_record"
REASONS = ("corrupt_record", "empty_article", "empty_summary", "summary_longer_than_article")


def check_columns(df: DataFrame, cols: Columns = DEFAULT) -> None:
    missing = [c for c in (cols.article, cols.summary) if c not in df.columns]
    if missing:
        raise DataValidationError(f"No column named {' or '.join(missing)} in the table")


def add_checks(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Add word counts of the raw text and `reject_reason` (null for good rows).

    A table that has the checks already is returned as it is. Lines that a reader
    could not parse (`_corrupt_record`) are rejected as such.
    """
    check_columns(df, cols)
    if "reject_reason" in df.columns:
        return df
    df = compute_once(df, {
        "article_words": text.word_count(F.coalesce(F.col(cols.article).cast("string"), F.lit(""))),
        "summary_words": text.word_count(F.coalesce(F.col(cols.summary).cast("string"), F.lit(""))),
    })
    return df.withColumn(
        "reject_reason",
        F.when(F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False), "corrupt_record")
        .when(F.col("article_words") == 0, "empty_article")
        .when(F.col("summary_words") == 0, "empty_summary")
        .when(F.col("article_words") < F.col("summary_words"), "summary_longer_than_article"),
    )


def quarantine(df: DataFrame, cols: Columns = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """The good rows as they were, and the rejected rows with their reason.

    Of a good row's article no more words are looked for than its summary has.
    """
    checked = add_checks(df, cols)
    rejected = checked.where("reject_reason is not null")
    if {"reject_reason", "article_words", "summary_words"} & set(df.columns):
        return checked.where("reject_reason is null").select(*df.columns), rejected
    article, summary = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (cols.article, cols.summary))
    fine = bind(text.word_count(summary), lambda n: (n > 0) & text.has_words(article, n))
    if CORRUPT in df.columns:
        fine = F.col(CORRUPT).isNull() & fine
    return compute_once(df, {"reject_reason": fine}).where("reject_reason").select(*df.columns), rejected


def _blank(value: Column) -> Column:
    """True for texts without a word, null included."""
    return ~F.coalesce(value.cast("string"), F.lit("")).rlike(f"[^{P.WS_RANGES}]")


def offenders(df: DataFrame, reason: str, cols: Columns = DEFAULT, n: int = 5) -> DataFrame:
    """The first n rows (by id) rejected for a reason, as an error message lists them.

    A blank text is told by its first visible character: only the other reasons need word counts.
    """
    check_columns(df, cols)
    if "reject_reason" not in df.columns and reason in ("empty_article", "empty_summary"):
        article, summary = (_blank(F.col(c)) for c in (cols.article, cols.summary))
        bad = df.where(article if reason == "empty_article" else ~article & summary)
        bad = bad.where(F.col(CORRUPT).isNull()) if CORRUPT in df.columns else bad
    else:
        bad = add_checks(df, cols).where(F.col("reject_reason") == reason)
    return bad.select(cols.id).orderBy(cols.id).limit(n)


def pair_digest(*columns: Column) -> Column:
    """Fixed-width stand-in for a tuple of texts: equal tuples, nulls included, agree."""
    framed = [
        F.coalesce(F.concat(F.lit("="), F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
        for c in columns
    ]
    return F.unhex(F.sha2(F.concat(*framed), 256))


def _copies(df: DataFrame, cols: Columns, *also: Column) -> DataFrame:
    """One row per distinct (article, summary) and what else is named, with its number of copies.

    The text is reduced to a digest before the shuffle and counted on the map
    side, so a pair that fills a third of the table costs one row per task.
    """
    digest = pair_digest(F.col(cols.article).cast("string"), F.col(cols.summary).cast("string"))
    keyed = add_checks(df, cols).select(digest.alias("d"), "article_words", "summary_words", "reject_reason", *also)
    return keyed.groupBy(*keyed.columns).agg(F.count("*").alias("n"))


def _lengths(words: str) -> Column:
    n = F.sum("n")
    return F.struct(
        (F.sum(F.col(words) * F.col("n")) / n).alias("mean"),
        # Distinct word counts are bounded by the longest text, and so is the state.
        F.percentile(F.col(words), F.lit(0.5), F.col("n")).alias("median"),
        F.min(words).alias("min"),
        F.max(words).alias("max"),
    )


def profile(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """One row: rows, columns, sources, word counts, duplicates, rejected rows by reason.

    `sources` is the number of distinct sources; `distinct_sources` lists them.
    The texts are read once: copies are counted per digest and source and written; digests per word
    counts and the sources follow from that small table.
    """
    check_columns(df, cols)
    named = cols.source and cols.source in df.columns
    source = F.col(cols.source).cast("string") if named else F.lit(None).cast("string")
    copies = written(_copies(df, cols, source.alias("_source")), "copies")
    n_sources = copies.select("_source").where("_source is not null").distinct().agg(F.count("*")).scalar()
    reason = F.col("reject_reason")
    checked = ["article_words", "summary_words", "reject_reason"]
    lengths = copies.groupBy("d", *checked).agg(F.sum("n").alias("n")).groupBy(*checked).agg(
        F.sum("n").alias("n"), F.count("*").alias("pairs")
    )
    columns = [c for c in df.columns if c not in ("article_words", "summary_words", "reject_reason", CORRUPT)]
    return lengths.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.lit(columns).alias("columns"),
        _lengths("article_words").alias("article_lengths"),
        _lengths("summary_words").alias("summary_lengths"),
        F.coalesce(F.sum(F.col("n") - F.col("pairs")), F.lit(0)).alias("duplicate_rows"),
        *[F.coalesce(F.sum(F.when(reason == r, F.col("n"))), F.lit(0)).alias(f"{r}_rows") for r in REASONS],
    ).withColumn("sources", n_sources)


def duplicate_count(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Rows beyond the first of every (article, summary); nulls are equal."""
    return _copies(df, cols).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def snapshot_counts(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Empty articles, empty references and duplicate pairs in one pass."""
    return _copies(df, cols).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("article_words") == 0, F.col("n"))), F.lit(0)).alias("empty_articles"),
        F.coalesce(F.sum(F.when(F.col("summary_words") == 0, F.col("n"))), F.lit(0)).alias("empty_references"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_pairs"),
    )


def distinct_sources(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Every non-null source once, as text, sorted."""
    source = F.col(cols.source).cast("string")
    return df.select(source.alias("source")).where("source is not null").distinct().orderBy("source")


def validate(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Raise on the first failed check, in the fixed order; return the profile.

    Columns, empty table, empty articles, empty summaries, swapped columns;
    duplicates only warn. Runs one aggregate, and a top-5 query only on failure.
    """
    report = profile(df, cols)
    row = report.first()
    if row["rows"] == 0:
        raise DataValidationError("The table has no rows")
    messages = {
        "corrupt_record": "Lines that could not be parsed",
        "empty_article": f"Rows without text in the article column {cols.article}",
        "empty_summary": f"Rows without text in the summary column {cols.summary}",
        "summary_longer_than_article": "Rows whose summary has more words than the article (are the columns swapped?)",
    }
    for reason, message in messages.items():
        if row[f"{reason}_rows"]:
            where = ""
            if cols.id and cols.id in df.columns:
                first = [str(r[0]) for r in offenders(df, reason, cols).collect()]
                where = f", first ids: {', '.join(first)}"
            raise DataValidationError(message + where)
    if row["duplicate_rows"]:
        warnings.warn(
            f"{row['duplicate_rows']} rows repeat the article and summary of an earlier one",
            UserWarning, stacklevel=2,
        )
    return report


def prepare(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Clean both text columns and keep every other column."""
    check_columns(df, cols)
    return df.withColumns(
        {c: text.normalize_article(text.strip_html(F.col(c))) for c in (cols.article, cols.summary)}
    )
