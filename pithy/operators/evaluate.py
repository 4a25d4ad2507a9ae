"""Score summarisers against reference summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pithy.functions import text
from pithy.operators.quality import DEFAULT, Columns
from pithy.operators.rouge import VARIANTS, add_rouge, check_variants, prepare_tokens, token_columns
from pithy.operators.split import cap_rows
from pithy.operators.summarize import Method, add_summaries, choose_methods

ALL_VARIANTS = tuple(VARIANTS)


def score_methods(
    pairs: DataFrame, methods: Sequence[str | Method] | None = None, n: int = 3,
    variants: Sequence[str] = ALL_VARIANTS, stem: bool = True, max_examples: int | None = None,
    cols: Columns = DEFAULT, timed: bool = False,
) -> DataFrame:
    """One row per article and method: summary, lengths, ROUGE scores, id and source.

    `pairs` holds prepared text. Sentences and tokens are computed once per article
    for all methods; the plan has no shuffle. With `timed`,
    elapsed_seconds is the time this run takes for the row's summary, else zero.
    """
    chosen = choose_methods(methods)
    check_variants(variants)
    if max_examples:
        pairs = cap_rows(pairs, max_examples, cols.id)
    kept = [c for c in (cols.id, cols.source) if c and c in pairs.columns]
    df = pairs.select(
        *kept,
        F.coalesce(F.col(cols.article).cast("string"), F.lit("")).alias("article"),
        F.coalesce(F.col(cols.summary).cast("string"), F.lit("")).alias("reference_summary"),
    )
    df = df.withColumn("article_length", text.word_count(F.col("article")))
    df = add_summaries(df, chosen, n, timed=timed)
    texts = [("reference_summary", "_reference"), *{f"summary_{m.name}": f"_summary_{m.name}" for m in chosen}.items()]
    df = prepare_tokens(df.drop("sentences"), texts, variants, stem)
    wide = [c for c in df.columns if c.startswith(("summary_", "_summary_", "seconds_"))]
    tokens = token_columns("_candidate", variants, stem)
    one = F.explode(F.array(*[
        F.struct(
            F.lit(m.name).alias("method"), F.col(f"summary_{m.name}").alias("summary"),
            (F.col(f"seconds_{m.name}") if timed else F.lit(0.0)).alias("seconds"),
            *[F.col(own).alias(c) for own, c in zip(token_columns(f"_summary_{m.name}", variants, stem), tokens)],
        )
        for m in chosen
    ]))
    df = (
        df.withColumn("_one", one)
        .withColumns({
            "method": F.col("_one.method"), "generated_summary": F.col("_one.summary"), "elapsed_seconds": F.col("_one.seconds"),
            **{c: F.col("_one")[c] for c in tokens},
        })
        .drop("_one", *wide)
        .withColumn("summary_length", text.word_count(F.col("generated_summary")))
    )
    scored = add_rouge(
        df, "reference_summary", "generated_summary", variants, stem, "_reference", "_candidate"
    )
    head = ["method", "article", "reference_summary", "generated_summary", "summary_length",
            "elapsed_seconds"]
    scores = [f"{v}_{part}" for v in variants for part in ("f1", "precision", "recall")]
    return scored.select(*head, *scores, *kept, "article_length")


def compression() -> Column:
    """Summary words per article word; null for blank articles, so means skip them."""
    ratio = text.compression_ratio(F.col("summary_length"), F.col("article_length"))
    return F.when(F.col("article_length") > 0, ratio)


def method_summary(scores: DataFrame, variants: Sequence[str] = ALL_VARIANTS) -> DataFrame:
    """Means per method: one small aggregate row per method and task is shuffled."""
    def mean(c: Column) -> Column:
        return F.coalesce(F.avg(c), F.lit(0.0))

    return scores.groupBy("method").agg(
        F.count("*").alias("n_examples"),
        *[mean(F.col(f"{v}_f1")).alias(v) for v in variants],
        mean(F.col("summary_length")).alias("mean_summary_length"),
        mean(compression()).alias("mean_compression_ratio"),
        mean(F.col("elapsed_seconds")).alias("mean_inference_seconds"),
    )


def precision_recall(scores: DataFrame, variants: Sequence[str] = ALL_VARIANTS) -> DataFrame:
    """Mean precision and recall per method and variant."""
    return scores.groupBy("method").agg(*[
        F.avg(f"{v}_{part}").alias(f"{v}_{part}") for v in variants for part in ("precision", "recall")
    ])


def rounded_summary(summary: DataFrame) -> DataFrame:
    """Report rounding: scores, ratio and seconds to 4 places, lengths to 2."""
    places = {"mean_summary_length": 2}
    return summary.select(*[
        c if c in ("method", "n_examples") else F.round(c, places.get(c, 4)).alias(c)
        for c in summary.columns
    ])
