"""Benchmark decontamination: SimHash of item-sized windows, exact check of the candidates.

DataFrame operations only.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pithy.session import written

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
BLOCKS = 7


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(words: Column, size: int) -> Column:
    """Hashes of all runs of `size` words, in order; none if there are fewer words."""
    last = F.size(words) - size
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)]))
    return F.when(last >= 0, hashes).otherwise(F.array().cast("array<bigint>"))


def marked(hashes: Column) -> Column:
    """A multiset as a set: every hash together with the number of its occurrence."""
    ordered = F.array_sort(hashes)
    return F.transform(ordered, lambda x, i: F.xxhash64(x, i.cast("long") - F.array_position(ordered, x)))


def simhash(hashes: Column) -> Column:
    """Bit b is 1 if it is set in over half of the hashes."""
    def bit(acc: Column, b: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0), lambda n, h: n + F.call_function("shiftright", h, b).bitwiseAND(F.lit(1).cast("long")).cast("int"))
        return acc.bitwiseOR(F.when(2 * ones > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), bit)


def blocks_of(blocks: int) -> list[tuple[int, int]]:
    """(shift, width) of each block of the 64 bits."""
    cuts = np.linspace(0, 64, blocks + 1).astype(int)
    return [(int(a), int(b - a)) for a, b in zip(cuts, cuts[1:])]


def block_values(fp: Column, blocks: int) -> list[Column]:
    return [F.shiftrightunsigned(fp, s).bitwiseAND((1 << w) - 1) for s, w in blocks_of(blocks)]


def flips(width: int, most: int) -> list[int]:
    """Every pattern of at most `most` flipped bits in a block."""
    return [reduce(int.__or__, (1 << i for i in c), 0) for n in range(most + 1) for c in combinations(range(width), n)]


def needed(m: Column, similarity: float, other: Column | None = None) -> Column:
    """Least common shingles of sets of m and `other` (default m) that are similar enough."""
    return F.ceil((m + (m if other is None else other)) * (similarity / (1 + similarity)) - 1e-9).cast("int")


def benchmark_items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, words, k, shingles): items without words are left out; short ones are one shingle."""
    rows = benchmark.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col).cast("string")).alias("w"))
    rows = rows.where(F.size("w") > 0).withColumn("words", F.size("w"))
    by_size = F.when(F.col("words") >= SHINGLE, shingles(F.col("w"), SHINGLE))
    for k in range(1, SHINGLE):
        by_size = by_size.when(F.col("words") == k, shingles(F.col("w"), k))
    return rows.select("item_id", "words", F.least("words", F.lit(SHINGLE)).alias("k"), by_size.alias("shingles"))


def candidate_windows(rows: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """(doc, tkey, words, start, n): windows that share enough shingles with the benchmark's items of `words` words.

    A window has n = `words` words; a text of fewer words is one window as a whole.
    Lossless: a window as similar as asked to an item of that size has at least
    `needed` positions whose shingle occurs in an item of that size.
    """
    known = items.select("k", "words", F.explode("shingles").alias("h")).groupBy("k", "h").agg(
        F.collect_set("words").alias("sizes")
    )
    known = written(known, "benchmark-shingles")
    lengths = [r.k for r in items.select("k").distinct().orderBy("k").collect()]  # at most SHINGLE numbers
    if not lengths:
        return rows.select("doc", "tkey", *[F.lit(0).alias(c) for c in ("words", "start", "n")]).where(F.lit(False))
    # Counted before the rows multiply, so that none of them carries the text's words.
    words = rows.select("doc", "tkey", words_of(F.col("text")).alias("w")).withColumn("n", F.size("w"))
    every = F.flatten(F.array(*[
        F.transform(shingles(F.col("w"), k), lambda h, i: F.struct(F.lit(k).alias("k"), i.alias("at"), h.alias("h"))) for k in lengths
    ]))
    hits = words.select("doc", "tkey", "n", F.explode(every).alias("x")).select("doc", "tkey", "n", "x.*").join(known, ["k", "h"])
    hits = hits.select("doc", "tkey", "n", "at", F.explode("sizes").alias("words")).distinct()
    m = F.col("words") - F.least("words", F.lit(SHINGLE)) + 1
    own = F.least("n", "words") - F.least("words", F.lit(SHINGLE)) + 1
    lists = (
        hits.groupBy("doc", "tkey", "n", "words").agg(F.array_sort(F.collect_list("at")).alias("p"))
        .withColumn("m", m).withColumn("need", needed(F.col("m"), similarity, own))
        .where(F.size("p") >= F.col("need"))
    )
    # The i-th hit begins a run of `need` hits that one window can hold.
    runs = F.transform(
        F.sequence(F.lit(0), F.size("p") - F.col("need")),
        lambda i: F.struct(
            F.get("p", i).alias("at"),
            (F.get("p", i) + F.col("m") - 1 - F.get("p", i + F.col("need") - 1)).alias("room"),
        ),
    )
    whole = lists.where("n < words").select("doc", "tkey", "words", F.lit(0).alias("start"), "n")
    runs = lists.where("n >= words").select("doc", "tkey", "words", "m", "need", F.explode(runs).alias("r")).where("r.room >= 0")
    first = F.greatest(F.lit(0), F.col("r.at") - F.least(F.col("r.room"), F.col("m") - F.col("need")))
    starts = runs.select("doc", "tkey", "words", F.explode(F.sequence(first, F.col("r.at"))).alias("start")).distinct()
    return starts.withColumn("n", F.col("words")).unionByName(whole)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS,
) -> DataFrame:
    """(id_col, item_id, similarity, start_word, n_words, hamming): a row per document and item it holds.

    A window of as many words as the item is fingerprinted, or the whole of a text
    that has fewer; `n_words` is the window's number of words. Fingerprints within
    `radius` bits share a block up to radius / BLOCKS flipped bits, and items are
    listed under all such blocks, so the join finds every pair within the radius;
    then the weighted Jaccard similarity of their five-word shingles (weight: number
    of occurrences) decides exactly. The best window of a document and item is
    reported, the first of equals. At the least similarity about 10 of 64 bits are
    expected to differ; the default radius lies over three deviations above.

    Null or word-less texts match nothing. Items under five words are one shingle of
    all their words. Documents that share id and text give one row; a null id is an
    id of its own. Either table may be empty; other columns are ignored.

    The bulk path scans texts twice (for windows, and for texts shorter than an item), without shuffle while the benchmark's shingles
    are small enough to broadcast (Spark checks the written table's size; beyond
    that it joins by shuffle). Windows are made only where enough of their shingles
    occur in the benchmark, which no match can fail. Texts are read once more for
    the documents that have such windows.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("tkey"), text.alias("text"))
    items = written(benchmark_items(benchmark, item_col, item_text), "benchmark-items")
    per_doc = candidate_windows(rows, items, similarity).groupBy("doc", "tkey").agg(
        F.collect_list(F.struct("words", "start", "n")).alias("windows")
    ).select(F.col("doc").alias("d"), F.col("tkey").alias("t"), "windows")
    per_doc = written(per_doc, "windows")

    there = rows.join(per_doc, F.col("doc").eqNullSafe(F.col("d")) & (F.col("tkey") == F.col("t")))
    there = there.select("doc", "tkey", words_of(F.col("text")).alias("w"), "windows")
    there = there.withColumn("by_size", F.array(*[
        F.when(F.exists("windows", lambda x: F.least(x["words"], F.lit(SHINGLE)) == k), shingles(F.col("w"), k))
        for k in range(1, SHINGLE + 1)
    ])).select("doc", "tkey", "by_size", "windows")

    def cut(x: Column) -> Column:
        k = F.least(x["words"], F.lit(SHINGLE))
        return F.struct(x["words"].alias("words"), x["start"].alias("start"), x["n"].alias("n"),
                        F.slice(F.get("by_size", k - 1), x["start"] + 1, x["n"] - k + 1).alias("s"))

    # Cut before the rows multiply, so that no row carries a whole text's shingles.
    windows = there.select("doc", "tkey", F.explode(F.transform("windows", cut)).alias("x")).select("doc", "tkey", "x.*")
    windows = windows.where(F.size("s") == F.col("n") - F.least("words", F.lit(SHINGLE)) + 1)
    windows = written(
        windows.select("doc", "tkey", "words", "start", "n", marked(F.col("s")).alias("marked"), simhash(F.col("s")).alias("fp")),
        "fingerprints",
    )

    most = radius // BLOCKS
    listed = items.select("item_id", "words", marked(F.col("shingles")).alias("item"), simhash(F.col("shingles")).alias("item_fp"))
    patterns = F.array(*[
        F.struct(F.lit(i).alias("block"), F.lit(flip).cast("long").alias("flip"))
        for i, (_, width) in enumerate(blocks_of(BLOCKS)) for flip in flips(width, most)
    ])
    values = F.array(*block_values(F.col("item_fp"), BLOCKS))
    variants = F.transform(patterns, lambda x: F.struct(
        x["block"].alias("block"), F.get(values, x["block"]).bitwiseXOR(x["flip"]).alias("bits")))
    listed = written(listed.select("*", F.explode(variants).alias("v")).select("*", "v.block", "v.bits").drop("v"), "items")
    keys = F.array(*[
        F.struct(F.lit(i).alias("block"), v.alias("bits")) for i, v in enumerate(block_values(F.col("fp"), BLOCKS))
    ])
    near = windows.select("*", F.explode(keys).alias("v")).select("*", "v.block", "v.bits").drop("v").join(
        listed, ["words", "block", "bits"]
    ).withColumn("hamming", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))).where(F.col("hamming") <= radius)
    # A pair that meets in several blocks is checked in the first of them.
    differ = F.col("fp").bitwiseXOR(F.col("item_fp"))
    meets = [F.bit_count(v) <= most for v in block_values(differ, BLOCKS)]
    first = F.coalesce(*[F.when(hit, F.lit(i)) for i, hit in enumerate(meets)])
    common = F.size(F.array_intersect("marked", "item"))
    found = near.where(F.col("block") == first).withColumn(
        "similarity", common / (F.size("marked") + F.size("item") - common)
    ).where(F.col("similarity") >= similarity)
    best = found.groupBy("doc", "tkey", "item_id").agg(
        F.max_by(F.struct("similarity", "start", "n", "hamming"), F.struct("similarity", -F.col("start"))).alias("m")
    )
    return best.select(
        F.col("doc").alias(id_col), "item_id", F.col("m.similarity").alias("similarity"),
        F.col("m.start").cast("long").alias("start_word"), F.col("m.n").cast("long").alias("n_words"),
        F.col("m.hamming").cast("long").alias("hamming"),
    )
