"""Report tables over corpora and over scored summaries.

Grouping columns with few values (method, split, source) are always aggregated on
the map side first. Medians and quartiles keep one counter per distinct value:
word counts are bounded by the longest text, and scores and ratios are rounded to
six places first, so a counter never grows with the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pithy.functions import text
from pithy.operators.evaluate import ALL_VARIANTS, compression
from pithy.operators.quality import DEFAULT, Columns

PLACES = 6


def _unpivot(df: DataFrame, keys: Sequence[str], values: Sequence[str], name: str) -> DataFrame:
    """Long form: one row per key and value column."""
    return df.unpivot(list(keys), list(values), name, "value")


def _distribution(value: Column) -> list[Column]:
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return [
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.get(q, F.lit(1)).alias("median"),
        F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
        F.get(q, F.lit(0)).alias("p25"), F.get(q, F.lit(2)).alias("p75"), F.max(value).alias("max"),
    ]


def corpus_lengths(pairs: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Add article_words, summary_words, sentence_count and reference_compression."""
    article = F.coalesce(F.col(cols.article), F.lit(""))
    return pairs.withColumns({
        "article_words": text.word_count(article),
        "summary_words": text.word_count(F.coalesce(F.col(cols.summary), F.lit(""))),
        "sentence_count": F.size(text.split_sentences(article)),
    }).withColumn(
        "reference_compression",
        F.round(text.compression_ratio(F.col("summary_words"), F.col("article_words")), PLACES),
    )


def describe_lengths(pairs: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Count, mean, median, std, min, quartiles and max of the four corpus measures."""
    measures = ["article_words", "summary_words", "sentence_count", "reference_compression"]
    lengths = corpus_lengths(pairs, cols).select(*[F.col(m).cast("double").alias(m) for m in measures])
    return _unpivot(lengths, [], measures, "statistic").groupBy("statistic").agg(
        *_distribution(F.col("value"))
    )


def split_skew(pairs: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Rows and mean lengths per split."""
    return corpus_lengths(pairs, cols).groupBy("split").agg(
        F.count("*").alias("rows"),
        F.avg("article_words").alias("mean_article_words"),
        F.avg("summary_words").alias("mean_summary_words"),
        F.avg("reference_compression").alias("mean_reference_compression"),
    )


def score_distribution(scores: DataFrame, variants: Sequence[str] = ALL_VARIANTS) -> DataFrame:
    """Distribution of F1 per method and variant, with the interquartile range."""
    f1 = scores.select("method", *[F.round(f"{v}_f1", PLACES).alias(v) for v in variants])
    long = _unpivot(f1, ["method"], variants, "variant")
    return (
        long.groupBy("method", "variant").agg(*_distribution(F.col("value")))
        .withColumn("iqr", F.col("p75") - F.col("p25"))
    )


def rouge_matrix(summary: DataFrame, variants: Sequence[str] = ALL_VARIANTS) -> DataFrame:
    """Methods by variants in long form, as a grouped bar chart reads it."""
    return _unpivot(summary.select("method", *variants), ["method"], variants, "variant").select(
        "method", "variant", F.col("value").alias("f1")
    )


def rouge_pivot(scores: DataFrame, variants: Sequence[str] = ALL_VARIANTS) -> DataFrame:
    """Methods by variants, one column per variant."""
    long = _unpivot(
        scores.select("method", *[F.col(f"{v}_f1").alias(v) for v in variants]), ["method"], variants, "variant"
    )
    return long.groupBy("method").pivot("variant", list(variants)).agg(F.avg("value"))


def paired_rows(
    scores: DataFrame, left: str, right: str, metric: str = "rouge1_f1", id_col: str = "id"
) -> DataFrame:
    """One row per id with the scores of two methods side by side.

    `copies` counts the rows behind it: rows that share an id are copies of one
    article and score alike.
    """
    def of(name: str) -> Column:
        return F.max(F.when(F.col("method") == name, F.round(metric, PLACES)))

    both = scores.where(F.col("method").isin(left, right)).groupBy(id_col).agg(
        of(left).alias("left_score"), of(right).alias("right_score"),
        F.count_if(F.col("method") == left).alias("copies"),
    )
    return both.where("left_score is not null and right_score is not null")


def paired_comparison(
    scores: DataFrame, left: str, right: str, metric: str = "rouge1_f1", id_col: str = "id"
) -> DataFrame:
    """Wins of either method and ties, on scores rounded to six places."""
    a, b = F.col("left_score"), F.col("right_score")

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("copies"))), F.lit(0))

    return paired_rows(scores, left, right, metric, id_col).agg(
        F.lit(left).alias("left_method"), F.lit(right).alias("right_method"),
        rows(a > b).alias("left_wins"), rows(a < b).alias("right_wins"), rows(a == b).alias("ties"),
    )


def best_and_worst(scores: DataFrame, metric: str = "rouge1_f1", id_col: str = "id") -> DataFrame:
    """Best and worst article of every method; ties go to the lowest id."""
    rounded = scores.select("method", F.round(metric, PLACES).alias("s"), F.col(id_col).alias("id"))
    ends = rounded.groupBy("method").agg(F.max("s").alias("best_score"), F.min("s").alias("worst_score"))
    # One row per method.
    at_ends = rounded.join(F.broadcast(ends), "method").where("s = best_score or s = worst_score")
    return at_ends.groupBy("method", "best_score", "worst_score").agg(
        F.min(F.when(F.col("s") == F.col("best_score"), F.col("id"))).alias("best_id"),
        F.min(F.when(F.col("s") == F.col("worst_score"), F.col("id"))).alias("worst_id"),
    ).select("method", "best_id", "best_score", "worst_id", "worst_score")


def length_histogram(df: DataFrame, text_col: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram of word counts over [min, max], last bin closed.

    Every bin appears, also with no rows. A single value falls into the middle of
    a unit-wide range, as plotting libraries have it.
    """
    words = df.select(text.word_count(F.coalesce(F.col(text_col), F.lit(""))).alias("words"))
    counts = words.groupBy("words").agg(F.count("*").alias("n"))
    # One row, no longer than the longest text has words: the texts are read once.
    lo, hi = F.min("words").cast("double"), F.max("words").cast("double")
    whole = counts.agg(
        F.when(lo == hi, lo - 0.5).otherwise(lo).alias("lo"),
        F.when(lo == hi, hi + 0.5).otherwise(hi).alias("hi"),
        F.collect_list(F.struct("words", "n")).alias("counts"),
    ).where("lo is not null")
    width = (F.col("hi") - F.col("lo")) / bins

    def place(words: Column) -> Column:
        return F.least(F.lit(bins), F.floor((words - F.col("lo")) / width) + 1)

    inside = F.filter("counts", lambda c: place(c["words"]) == F.col("bin"))
    return whole.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins)))).select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * width).alias("from_words"),
        (F.col("lo") + F.col("bin") * width).alias("to_words"),
        F.aggregate(inside, F.lit(0).cast("long"), lambda total, c: total + c["n"]).alias("rows"),
    )


def compression_by_method(summary: DataFrame) -> DataFrame:
    """Mean compression and length per method."""
    return summary.select("method", "mean_compression_ratio", "mean_summary_length")


def score_curve(scores: DataFrame, metric: str = "rouge1_f1") -> DataFrame:
    """Scores of each method from best to worst, with the positions each one takes.

    The curve of sorted scores as runs: equal scores are one row from
    `from_position` to `to_position`. It says the same as one row per position,
    and its size is bounded by the distinct scores, not by the rows.
    """
    if metric not in scores.columns:
        raise ValueError(f"The scores hold no column {metric!r}.")
    runs = scores.groupBy("method", F.round(metric, PLACES).alias("score")).agg(F.count("*").alias("n"))
    best_first = Window.partitionBy("method").orderBy(F.col("score").desc()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    upto = F.sum("n").over(best_first)
    return runs.withColumn("to_position", upto).select(
        "method", "score", (F.col("to_position") - F.col("n") + 1).alias("from_position"), "to_position"
    )


def length_band(words: Column) -> Column:
    """Bands of article length."""
    return (
        F.when(words < 100, "000-099").when(words < 250, "100-249")
        .when(words < 500, "250-499").otherwise("500+")
    )


def quality_by_characteristic(
    scores: DataFrame, by: Sequence[str] = ("source",), metric: str = "rouge1_f1"
) -> DataFrame:
    """Mean score, compression and rows per method, length band and further columns."""
    return scores.withColumn("length_band", length_band(F.col("article_length"))).groupBy(
        "method", *by, "length_band"
    ).agg(
        F.count("*").alias("rows"), F.avg(metric).alias(f"mean_{metric}"),
        F.avg(compression()).alias("mean_compression_ratio"),
    )


def with_metadata(df: DataFrame, metadata: DataFrame, key: str = "id") -> DataFrame:
    """Attach metadata kept in its own table, one row per key; rows without any stay.

    No broadcast hint: Spark measures the metadata side and broadcasts it only
    below its size threshold, and merges the two sides by key beyond that.
    """
    return df.join(metadata, key, "left")
