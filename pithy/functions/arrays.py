"""Array helpers that keep counting inside the row: no shuffle, no Python."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are costly to compute and used more than once later.

    Like `withColumns`, but through a one-row generator. The optimizer neither
    pushes filters through it nor merges it with later projections, either of
    which would repeat the expressions (it does both for chained Arrow UDFs and
    for filters on computed columns).
    """
    kept = [c for c in df.columns if c not in columns]
    made = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(made)))


def stopwatch(df: DataFrame, columns: dict[str, Column], seconds: str) -> DataFrame:
    """Like `compute_once`, and the seconds each row took in a column of its own.

    The clock is read before and after, in the order of the row's fields. Only what the
    JVM computes is measured: Spark runs Python steps ahead of the projection.
    """
    clock = F.reflect(F.lit("java.lang.System"), F.lit("nanoTime")).cast("long")
    df = compute_once(df, {"_begin": clock, **columns, "_end": clock})
    return df.withColumn(seconds, (F.col("_end") - F.col("_begin")) / 1e9).drop("_begin", "_end")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate an expression once and use it many times inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined n-grams (n = 1 or 2)."""
    if n == 1:
        return tokens
    shorter = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, F.lit(1), shorter), F.slice(tokens, F.lit(2), shorter),
        lambda a, b: F.concat_ws(" ", a, b),
    )


def numbered(items: Column) -> Column:
    """Tell equal items apart: the first of each as it is, further ones by their number. Items hold no NUL.

    a, b, a, a -> a, b, a + NUL + 0, a + NUL + 1. Sorts once; only the further ones, few in a text,
    are walked run by run, so the cost is n log n.
    """

    def number_runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )

        def expand(at: Column) -> Column:
            runs = F.transform(
                at,
                lambda p, j: F.transform(
                    F.sequence(F.lit(0), F.coalesce(F.get(at, j + 1), F.size(ordered)) - p - 1),
                    lambda k: F.concat_ws("\x00", F.get(ordered, p), k),
                ),
            )
            return F.flatten(runs)

        return F.when(F.size(ordered) > 0, bind(starts, expand)).otherwise(
            F.array().cast("array<string>")
        )

    def tell_apart(ordered: Column) -> Column:
        further = F.filter(ordered, lambda item, i: (i > 0) & (item == F.get(ordered, i - 1)))
        return F.concat(F.array_distinct(ordered), bind(further, number_runs))

    return bind(F.sort_array(items), tell_apart)


def multiset_overlap(left: Column, right: Column) -> Column:
    """Size of the multiset intersection of two numbered arrays."""
    return F.size(F.array_intersect(left, right))


def top_in_order(scores: Column, k: Column) -> Column:
    """Positions of the k best scores, ascending; equal scores favour the earlier one."""
    ranked = F.array_sort(
        F.transform(scores, lambda s, i: F.struct((-F.round(s, 10)).alias("s"), i.alias("i")))
    )
    return F.array_sort(F.transform(F.slice(ranked, F.lit(1), k), lambda r: r["i"]))
