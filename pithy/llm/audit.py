"""How filters overlap, in every order: unions and differences of sorted posting lists of failing documents."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import combinations, permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pithy.session import written

RANGE_BITS = 16
FILTERS = "ABCDE"


def filter_failures(text: Column) -> dict[str, Column]:
    """The row-local filters: few words, repeated words, many capitals, special characters."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * F.char_length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def gallop(ids: list[int], at: int, bound: int) -> int:
    """The first place from `at` on whose id is not below `bound`: doubling steps, then bisection in the last one."""
    step = 1
    while at + step <= len(ids) and ids[at + step - 1] < bound:
        at, step = at + step, 2 * step
    return bisect_left(ids, bound, at, min(at + step, len(ids)))


def union(lists: list[list[int]]) -> list[int]:
    """The ids in any of the sorted lists: the list with the least id gives its run below all the others' next ids."""
    lists = [ids for ids in lists if ids]
    if len(lists) < 2:
        return lists[0] if lists else []
    at, out = [0] * len(lists), []
    while lists:
        heads = [ids[i] for ids, i in zip(lists, at)]
        first = min(range(len(heads)), key=heads.__getitem__)
        others = [h for k, h in enumerate(heads) if k != first]
        if not others:
            out.extend(lists[0][at[0]:])
            break
        bound = min(others)
        end = gallop(lists[first], at[first], bound)
        out.extend(lists[first][at[first]:end])
        at[first] = end
        if end < len(lists[first]) and lists[first][end] == bound:  # the other list gives it
            at[first] += 1
        if at[first] == len(lists[first]):
            del lists[first], at[first]
    return out


def difference(ids: list[int], lists: list[list[int]]) -> list[int]:
    """The ids in none of the sorted lists, in runs up to the next id that any of them holds."""
    at, out, i = [0] * len(lists), [], 0
    while i < len(ids):
        bound = None
        for k, other in enumerate(lists):
            at[k] = gallop(other, at[k], ids[i])
            if at[k] < len(other) and (bound is None or other[at[k]] < bound):
                bound = other[at[k]]
        if bound is None:
            out.extend(ids[i:])
            break
        end = gallop(ids, i, bound)
        out.extend(ids[i:end])
        i = end + 1 if end < len(ids) and ids[end] == bound else end
    return out


def held(ids: list[int], other: list[int]) -> int:
    """How many ids the other list holds too."""
    return len(ids) - len(difference(ids, [other])) if ids and other else 0


def subsets(names: str) -> list[str]:
    return ["".join(c) for n in range(len(names) + 1) for c in combinations(names, n)]


def posting_lists(rows: DataFrame, names: str) -> DataFrame:
    """(part, range, one sorted list of failing ids per filter, good, toxic): at most 2^RANGE_BITS ids a list.

    rows: key, part, good, toxic and a condition per filter. Only failing documents travel.
    """
    fails = F.lit(False)
    for f in names:
        fails = fails | F.col(f)
    place = F.col("key").bitwiseAND((1 << RANGE_BITS) - 1).cast("int")
    return rows.where(fails).groupBy("part", F.shiftright("key", RANGE_BITS).alias("range")).agg(
        *[F.sort_array(F.collect_list(F.when(F.col(c), place))).alias(c) for c in (*names, "good", "toxic")]
    )


def differences(lists: DataFrame, names: str) -> DataFrame:
    """(part, filter, before, failing, fresh, good, toxic): ids that fail a filter and none of those before it, and labelled ones."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part, *columns, good, toxic in zip(*[batch.column(c).to_pylist() for c in ("part", *names, "good", "toxic")]):
                of = dict(zip(names, columns))
                for f in names:
                    for before in subsets(names.replace(f, "")):
                        fresh = difference(of[f], [of[b] for b in before if of[b]]) if before else of[f]
                        if of[f]:
                            rows.append((part, f, before, len(of[f]), len(fresh), held(fresh, good), held(fresh, toxic)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, [pa.string()] * 3 + [pa.int64()] * 4)],
                ["part", "filter", "before", "failing", "fresh", "good", "toxic"],
            )

    counts = ["failing", "fresh", "good", "toxic"]
    found = lists.mapInArrow(step, "part string, filter string, before string, failing long, fresh long, good long, toxic long")
    return found.groupBy("part", "filter", "before").agg(*[F.sum(c).alias(c) for c in counts])


def unions(lists: DataFrame, names: str) -> DataFrame:
    """(part, filters, gone): documents that fail any filter of a set."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part, *columns in zip(*[batch.column(c).to_pylist() for c in ("part", *names)]):
                of = dict(zip(names, columns))
                rows += [(part, s, len(union([of[f] for f in s]))) for s in subsets(names) if s]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, [pa.string(), pa.string(), pa.int64()])],
                ["part", "filters", "gone"],
            )

    return lists.mapInArrow(step, "part string, filters string, gone long").groupBy("part", "filters").agg(F.sum("gone").alias("gone"))


def first_copies(rows: DataFrame) -> DataFrame:
    """(copy, first) for every repeated text: its digest and its least id."""
    return rows.groupBy(F.col("digest").alias("copy")).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, with what the step does.

    A: under 50 words; B: fewer than 65 distinct in 100 words; C: more than 5 capitals
    in 100 characters; D: one of `#$%&*|`; E: the text of a smaller doc_id, anywhere
    in the table. A part is a value of source. Null texts and sources are empty. Every row
    is a document: of rows with one id and text none is a copy of the other, a null id
    is neither smaller than another nor larger. A document is good or toxic if any row of `labels` says
    so. An empty table has no parts. Other columns are ignored.

    Texts are read once and stay; digests and ids meet for E. Posting lists hold
    ids of one part within a range of 2^16, so a large part is many lists. Differences
    against every set of earlier filters and unions of all sets are counted in each, then added.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = written(docs.select(
        F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"),
        *[c.alias(n) for n, c in filter_failures(text).items()],
    ), "marked")
    of = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    firsts, of = written(first_copies(marked), "first-copies"), written(of, "labelled")
    no = F.lit(False)
    rows = marked.join(firsts, F.col("digest") == F.col("copy"), "left").withColumn("E", F.coalesce(F.col("doc_id") > F.col("first"), no))
    rows = rows.drop("digest", "copy", "first").join(of, F.col("doc_id") == F.col("labelled"), "left")
    rows = rows.withColumns({"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)})
    lists = written(posting_lists(rows, FILTERS), "posting-lists")

    orders = [
        ("".join(o), i + 1, o[i], "".join(sorted(o[:i])), "".join(sorted(o[: i + 1])), "".join(sorted(set(FILTERS) - {o[i]})))
        for o in permutations(FILTERS) for i in range(len(FILTERS))
    ]
    columns = ["filter_order", "step", "filter", "before", "filters", "others"]
    steps = F.broadcast(docs.sparkSession.createDataFrame(orders, "filter_order string, step int, filter string, before string, filters string, others string"))
    letters = F.explode(F.array(*[F.lit(f) for f in FILTERS])).alias("filter")
    parts = marked.groupBy("part").agg(F.count("*").alias("documents"))
    table = written(parts, "parts").select("part", "documents", letters).join(steps, "filter").select("part", "documents", *columns)
    fresh = written(differences(lists, FILTERS), "differences")
    gone = written(unions(lists, FILTERS), "unions")
    alone = fresh.select("part", "filter", F.col("before").alias("others"), F.col("fresh").alias("alone"))
    each = Window.partitionBy("part", "filter")
    zero = F.lit(0).cast("long")
    found = (
        table.join(fresh, ["part", "filter", "before"], "left").join(alone, ["part", "filter", "others"], "left").join(gone, ["part", "filters"], "left")
        .withColumns({c: F.coalesce(c, zero) for c in ("failing", "fresh", "alone", "gone", "good", "toxic")})
    )
    return found.select(
        "part", "filter_order", "step", (F.col("documents") - F.col("gone")).alias("kept"), F.col("fresh").alias("removed"),
        (F.col("failing") - F.col("fresh")).alias("redundant"), F.col("alone").alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), F.sum("fresh").over(each).alias("shapley"),
    )
