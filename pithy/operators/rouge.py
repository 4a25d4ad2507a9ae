"""ROUGE-1/2/L/Lsum precision, recall and F1, row by row.

Counting n-grams stays in the row as array expressions, so scoring adds no
shuffle whatever the size of the corpus or the repetition in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pithy.functions import arrow_udfs, text
from pithy.functions import patterns as P
from pithy.functions.arrays import compute_once, multiset_overlap, ngrams, numbered

# The variants and their n-gram order (None: longest common subsequence).
VARIANTS = {"rouge1": 1, "rouge2": 2, "rougeL": None, "rougeLsum": None}


def precision_recall_f1(hits: Column, n_reference: Column, n_candidate: Column) -> Column:
    """The three scores as a struct of doubles; 0 where a side is empty."""
    precision = hits / F.greatest(F.lit(1), n_candidate)
    recall = hits / F.greatest(F.lit(1), n_reference)
    total = precision + recall
    f1 = F.when(total > 0, 2 * precision * recall / F.when(total > 0, total)).otherwise(0.0)
    return F.struct(precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def prepare_tokens(df: DataFrame, texts: Sequence[tuple[str, str]], variants: Sequence[str], stem: bool) -> DataFrame:
    """Add the `token_columns` of every text, given as (source column, target).

    All texts of a row are stemmed in one Python step: a task holds a Python worker per step.
    """
    if stem:
        lines = "rougeLsum" in variants
        joined = F.array_join(F.array(*[_joined_tokens(F.col(source), lines) for source, _ in texts]), f" {P.MARK} ")
        df = compute_once(df, {"_stems": F.split(arrow_udfs.stem_tokens(joined), P.MARK)})
        made = {}
        for i, (_, target) in enumerate(texts):
            stems = F.get("_stems", F.lit(i))
            words = F.array_remove(F.split(stems, " "), "")
            made |= {target: F.array_remove(words, "\n"), f"{target}_lines": stems} if lines else {target: words}
        df = compute_once(df, made).drop("_stems")
    else:
        df = compute_once(df, {target: text.score_tokens(F.coalesce(F.col(source), F.lit(""))) for source, target in texts})
    grams = {
        f"{target}_{v}": numbered(ngrams(F.col(target), VARIANTS[v])) for _, target in texts for v in variants if VARIANTS[v]
    }
    return compute_once(df, grams) if grams else df


def token_columns(target: str, variants: Sequence[str], stem: bool) -> list[str]:
    """What `prepare_tokens` adds for a text: its tokens, its numbered n-grams and, for stemmed ROUGE-Lsum, its token lines."""
    lines = [f"{target}_lines"] if stem and "rougeLsum" in variants else []
    return [target, *[f"{target}_{v}" for v in variants if VARIANTS[v]], *lines]


def _joined_tokens(source: Column, lines: bool) -> Column:
    """The tokens of a text in one string, with its line breaks as tokens if `lines`."""
    whole = F.array_join(text.score_tokens(F.coalesce(source, F.lit(""))), " ")
    return F.when(source.contains("\n"), _lines_of_tokens(source)).otherwise(whole) if lines else whole


def _lines_of_tokens(source: Column) -> Column:
    """Token lines of a text: one line per newline-separated sentence."""
    lines = F.transform(
        F.split(F.coalesce(source, F.lit("")), "\n"),
        lambda line: F.array_join(text.score_tokens(line), " "),
    )
    return F.array_join(lines, " \n ")


def check_variants(variants: Sequence[str]) -> None:
    unknown = [v for v in variants if v not in VARIANTS]
    if unknown or not variants:
        raise ValueError(f"Unknown ROUGE variants {unknown}; choose from {', '.join(VARIANTS)}.")


def add_rouge(
    df: DataFrame, reference_col: str, candidate_col: str,
    variants: Sequence[str] = tuple(VARIANTS), stem: bool = True,
    tokens_of_reference: str | None = None, tokens_of_candidate: str | None = None,
) -> DataFrame:
    """Add `{variant}_precision`, `_recall` and `_f1` for every variant.

    `tokens_of_reference` and `tokens_of_candidate` name columns an earlier `prepare_tokens`
    made, for tables that hold several candidates per reference; they go.
    """
    check_variants(variants)
    given = {c for t in (tokens_of_reference, tokens_of_candidate) if t for c in token_columns(t, variants, stem)}
    columns = [c for c in df.columns if c not in given]
    ref, cand = tokens_of_reference or "_ref", tokens_of_candidate or "_cand"
    missing = [(reference_col, ref)] * (not tokens_of_reference) + [(candidate_col, cand)] * (not tokens_of_candidate)
    if missing:
        df = prepare_tokens(df, missing, variants, stem)
    n_ref, n_cand = F.size(ref), F.size(cand)

    hits: dict[str, tuple[Column, Column, Column]] = {}
    for v in variants:
        n = VARIANTS[v]
        if n:
            overlap = multiset_overlap(F.col(f"{ref}_{v}"), F.col(f"{cand}_{v}"))
            hits[v] = (overlap, F.size(f"{ref}_{v}"), F.size(f"{cand}_{v}"))
    lcs = {}
    if "rougeL" in variants or "rougeLsum" in variants:
        lcs["_lcs"] = arrow_udfs.lcs_length(F.array_join(ref, " "), F.array_join(cand, " "))
        hits["rougeL"] = (F.col("_lcs"), n_ref, n_cand)
    if "rougeLsum" in variants:
        # Without line breaks the union over sentences is the plain subsequence.
        broken = F.col(reference_col).contains("\n") | F.col(candidate_col).contains("\n")
        union = arrow_udfs.union_lcs_hits(*(
            F.when(broken, F.col(f"{target}_lines") if stem else _lines_of_tokens(F.col(c)))
            for c, target in ((reference_col, ref), (candidate_col, cand))
        ))
        lcs["_lsum"] = union
        hits["rougeLsum"] = (F.coalesce("_lsum", "_lcs"), n_ref, n_cand)

    if lcs:
        df = compute_once(df, lcs)
    df = compute_once(df, {f"_{v}": precision_recall_f1(*hits[v]) for v in variants})
    return df.select(
        *columns,
        *[
            F.col(f"_{v}")[part].alias(f"{v}_{part}")
            for v in variants for part in ("f1", "precision", "recall")
        ],
    )
