"""Sentence TF-IDF weights and similarity as tables.

Every text is its own corpus of sentences. One repartition of the texts by id shows
ids that several rows share; the weights, sums and similarities of a text are then
computed within its row, so words are neither shuffled nor sorted. Rows that
share an id, or have none, would be taken for one text: such tables are refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pithy.functions import arrow_udfs, text
from pithy.functions.stopwords import ENGLISH
from pithy.session import small_batches


def sentence_weights(
    df: DataFrame, id_col: str = "id", sentences_col: str = "sentences",
    stop_words: Sequence[str] = ENGLISH, *, packed: bool = False,
) -> DataFrame:
    """L2-normalised TF-IDF: (id, n_sentences, si, token, tf, df, weight).

    With `packed` one row per text, (id, n_sentences, cells): the form in which the
    functions below need no grouping. The run fails at the second row of an id and at a null one, in the same pass.
    """
    small_batches(df.sparkSession)
    nth = F.row_number().over(Window.partitionBy(id_col).orderBy(id_col))
    refused = F.raise_error(F.concat(F.lit("Not a unique id: "), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    texts = (
        df.select(id_col, F.col(sentences_col).alias("_all"))
        .repartition(id_col)
        .withColumn("_nth", nth)
        .withColumn("_s", F.when((F.col("_nth") > 1) | F.col(id_col).isNull(), refused.cast("array<string>")).otherwise(F.col("_all")))
    )
    tokens = F.transform("_s", lambda s: F.coalesce(text.weight_tokens(s, tuple(stop_words)), F.array().cast("array<string>")))
    cells = texts.select(id_col, F.size("_s").alias("n_sentences"), arrow_udfs.weight_cells(tokens).alias("cells"))
    return cells if packed else cells.select(id_col, "n_sentences", F.inline("cells"))


def _packed(weights: DataFrame, id_col: str) -> DataFrame:
    """One row per text; a table with one row per word is grouped by id."""
    small_batches(weights.sparkSession)
    if "cells" in weights.columns:
        return weights
    cell = F.struct(*[F.col(c) for c in ("si", "token", "tf", "df", "weight")])
    return weights.groupBy(id_col).agg(F.collect_list(cell).alias("cells"))


def sentence_strength(weights: DataFrame, id_col: str = "id") -> DataFrame:
    """Total cosine similarity of each sentence to all others of its text.

    The row sum of the similarity matrix without its diagonal, taken word by word
    from the column totals: linear in the words, no sentence pair is formed. Only
    sentences that share a word with another one appear; the others have 0.
    """
    found = arrow_udfs.strength_of_sentences(F.col("cells"))
    return _packed(weights, id_col).select(id_col, F.inline(found).alias("si", "strength"))


def similarity_to(weights: DataFrame, anchor: int = 0, id_col: str = "id") -> DataFrame:
    """Cosine similarity of every sentence to one sentence of its text (the lead by default).

    One row of the similarity matrix per text. Sentences that share no word with
    the anchor are left out: theirs is 0.
    """
    found = arrow_udfs.similarity_of_sentences(F.col("cells"), anchor)
    return _packed(weights, id_col).select(id_col, F.inline(found).alias("si", "similarity"))
