"""Near duplicates by SimHash, searched through a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pithy.llm.common import components, join_labels, key_changes, small_batches, split_hot_groups, whole_groups
from pithy.session import written

SEED = 42
FANOUT = 8
PAIRS_AT_ONCE = 1 << 15


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of every `size`-word shingle of a UTF-8 text; one hash of all words if there are fewer."""
    words = text.lower().split()  # on bytes: A-Z only, and only the six ASCII blanks
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    size = min(size, len(words))
    starts = [0, *ends[: len(words) - size]]
    pieces = (joined[i:j - 1] for i, j in zip(starts, ends[size - 1:]))
    return np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes; zero without hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at: at + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp): the 64-bit SimHash of every row's text as a signed long. No shuffle."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            fps = np.fromiter(
                (fingerprint(shingle_hashes(t.as_py() or b"", shingle)) for t in texts), np.uint64, len(texts)
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    small_batches(docs.sparkSession)
    columns = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return columns.mapInArrow(step, "id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each 64-bit code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def upper_level(value: np.ndarray, mask: np.ndarray, group: np.ndarray):
    """Nodes over runs of up to FANOUT neighbours of one group.

    A node keeps the bits (mask) on which all its children agree, and their
    values. Returns value, mask, group and the first child of each node.
    """
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    place = np.arange(len(group)) - np.repeat(starts, np.diff(np.r_[starts, len(group)]))
    first = np.flatnonzero(place % FANOUT == 0)
    ones = np.bitwise_and.reduceat(value & mask, first)
    zeros = np.bitwise_and.reduceat(~value & mask, first)
    return ones, ones | zeros, group[first], np.r_[first, len(group)]


def linked_pairs(fp: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of one group whose fingerprints differ in at most `radius` bits.

    Rows are sorted by group and Gray rank. The descent from the groups' roots
    compares nodes on the bits both have fixed and their ancestors had not, adds
    that to the differences so far, and drops whole pairs of subtrees once the
    sum passes the radius.
    """
    levels = [(fp, np.full(len(fp), ~np.uint64(0)), group, None)]
    while len(levels[-1][0]) > len(np.unique(group)):
        levels.append(upper_level(*levels[-1][:3]))
    roots = np.arange(len(levels[-1][0]))
    none = np.zeros(len(roots), np.uint64)
    stack = [(len(levels) - 1, roots, roots, none, none.astype(np.int64))]
    while stack:
        level, a, b, fixed, differ = stack.pop()
        if len(a) > PAIRS_AT_ONCE:
            for at in range(0, len(a), PAIRS_AT_ONCE):
                cut = slice(at, at + PAIRS_AT_ONCE)
                stack.append((level, a[cut], b[cut], fixed[cut], differ[cut]))
            continue
        value, mask = levels[level][:2]
        both = mask[a] & mask[b]
        differ = differ + np.bitwise_count((value[a] ^ value[b]) & both & ~fixed).astype(np.int64)
        near = differ <= radius
        a, b, fixed, differ = a[near], b[near], both[near], differ[near]
        if level == 0:
            apart = a < b
            yield a[apart], b[apart]
            continue
        bounds = levels[level][3]
        first_a, size_a, first_b, size_b = bounds[a], bounds[a + 1] - bounds[a], bounds[b], bounds[b + 1] - bounds[b]
        many = size_a * size_b
        of = np.repeat(np.arange(len(a)), many)
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        child_a, child_b = first_a[of] + step // size_b[of], first_b[of] + step % size_b[of]
        once = child_a <= child_b
        stack.append((level - 1, child_a[once], child_b[once], fixed[of][once], differ[of][once]))


def segment_keys(radius: int, segments: int) -> list[tuple[int, ...]]:
    """Bit masks of which any two fingerprints within the radius agree on at least one."""
    cuts = np.linspace(0, 64, segments + 1).astype(int)
    part = [((1 << int(j)) - 1) ^ ((1 << int(i)) - 1) for i, j in zip(cuts, cuts[1:])]
    masks = [reduce(int.__or__, c) for c in combinations(part, segments - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def fingerprint_links(fps: DataFrame, radius: int = 4, segments: int = 7, block: int = 4096) -> DataFrame:
    """(a, b): edges that connect exactly the fingerprints linked within `radius` bits.

    fps: distinct `fp`. Two fingerprints within the radius agree on `segments -
    radius` of the segments, so rows meet once per combination of that many; in
    a group the hierarchical index finds the pairs. Larger groups are split into
    pairs of blocks. A group gives a spanning forest of its links, never all pairs.
    """
    masks = F.array(*[F.lit(m).cast("long") for m in segment_keys(radius, segments)])
    keyed = fps.select("fp", F.posexplode(masks).alias("part", "mask")).select(
        "fp", "part", F.col("fp").bitwiseAND(F.col("mask")).alias("bits")
    )
    dealt = split_hot_groups(keyed, ["part", "bits"], F.xxhash64("fp"), block)
    keys = ["part", "bits", "block_a", "block_b"]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            starts = np.r_[0, key_changes(table, keys)]
            sizes = np.diff(np.r_[starts, table.num_rows])
            many = np.repeat(sizes > 1, sizes)
            fp = table.column("fp").to_numpy().view(np.uint64)[many]
            if not len(fp):
                continue
            group = np.repeat(np.arange(len(sizes)), sizes)[many]
            order = np.lexsort((gray_rank(fp), group))
            fp, group = fp[order], group[order]
            label = np.arange(len(fp))
            for a, b in linked_pairs(fp, group, radius):
                label = join_labels(label, a, b)
            moved = np.flatnonzero(label != np.arange(len(fp)))
            signed = fp.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[label[moved]])], ["a", "b"])

    return (
        dealt.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "fp")
        .mapInArrow(step, "a long, b long").distinct()
    )


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4,
) -> DataFrame:
    """(id_col, fingerprint, component_id) for every row of `docs`.

    Fingerprints that differ in at most `radius` bits link; component_id is the
    least id reachable. Rows without words (null, empty, blank) have fingerprint
    zero and link like any other. Repeated rows and ids are kept, one result row
    each; a null id never becomes a component's id unless all its ids are null.
    Other columns of `docs` are ignored, an empty table gives an empty result.

    Only (id, fingerprint) pairs are shuffled, and links are sought between
    distinct fingerprints, so exact copies cost one row whatever their number.
    """
    table = written(fingerprints(docs, id_col, text_col, shingle), "simhash")
    classes = written(table.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    links = components(fingerprint_links(classes.select("fp"), radius))
    linked = classes.join(links, classes.fp == links.node).select("fp", "root", "least")
    whole = linked.select("root", "least").unionByName(
        classes.join(links.select(F.col("root").alias("fp")).distinct(), "fp").select(F.col("fp").alias("root"), "least")
    ).groupBy("root").agg(F.min("least").alias("component"))
    members = linked.select("fp", "root").unionByName(whole.select(F.col("root").alias("fp"), "root"))
    of = classes.join(members.join(whole, "root").select("fp", "component"), "fp", "left").select(
        "fp", F.coalesce("component", "least").alias("component_id")
    )
    of = written(of, "components-of")  # a plain join of two tables is one whose hot fingerprints Spark can split
    return table.join(of, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
