"""Removal of byte strings that an earlier document also has, by suffix sorting.

Texts are cut into segments at minimizers: a window of `length` bytes belongs to the
least hash of its GRAM-byte strings, and neighbouring windows with the same least
hash form a segment. Equal windows have equal least hashes, so they meet in the group
of that hash, wherever they occur. A group's distinct segments are suffix-sorted;
equal windows are then neighbours, and each learns the least document that holds it.

Steps, on blocks of whole documents (about `block_bytes` of text, stored compressed):
1. every block lists its hashes by bucket; 2. buckets tell which occur in more than
one document, and which are frequent; 3. blocks send the distinct segments of those
hashes, those of very frequent hashes and of hashes with a long segment as single windows
under a hash of their own; 4. buckets sort and compare; 5. blocks mark the bytes found.
A block sends every distinct content once, so copies cost one record per block.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pithy.llm.common import small_batches, written_by
from pithy.llm.suffixgroups import ranges, suffix_order
from pithy.session import written

GRAM = 24  # three 8-byte words
SORTED = 96  # contents of a group up to which its suffixes are sorted
MANY = 20_000  # contents of a hash, or blocks that have it, beyond which its windows go one by one
LONG = 256  # windows of a segment, likewise
LONG_MARK = 65535
PART = 1 << 16
SORT_BYTES = 8 << 20
HELD_BYTES = 24 << 20
BUCKETS_A_TASK = 8
BUCKET_BYTES = 16 << 20  # text whose hashes a bucket holds
NO_ID = np.iinfo(np.int64).max  # a null id comes after all others


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position on."""
    x = data.astype(np.uint64)
    for width in (1, 2, 4):
        x = x[:-width] | (x[width:] << np.uint64(8 * width))
    n = len(data) - GRAM + 1
    h = x[:n] * np.uint64(0x9E3779B97F4A7C15)
    h += x[8: n + 8] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(31)
    h += x[16: n + 16] * np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have:]) if width > have else x


def segments(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, hash, and a hash of both ends of every segment; none crosses a document's bounds."""
    found = []
    last = len(data) - length + 1
    for at in range(0, max(last, 0), PART):
        stop = min(at + PART, last)
        grams = gram_hashes(data[at: stop + length - 1])
        least = sliding_least(grams, length - GRAM + 1)
        window = np.arange(at, stop)
        inner = bounds[(bounds > at) & (bounds < stop + length)]
        whole = np.ones(stop - at, bool)
        for b in inner:
            whole[max(0, b - length + 1 - at): max(0, b - at)] = False
        cut = np.r_[True, (least[1:] != least[:-1]) | (whole[1:] != whole[:-1])]
        # Documents shorter than a window leave no gap of their own: cut at every bound.
        marks = inner[inner < stop] - at
        cut[marks] = True
        first = np.flatnonzero(cut)
        size = np.diff(np.r_[first, stop - at])
        good = whole[first]
        first, size = first[good], size[good]
        ends = mixed(grams[first] + mixed(grams[first + size + length - 1 - GRAM] + size.astype(np.uint64)))
        found.append((window[first], size, least[first], ends))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def pack(*arrays: np.ndarray | bytes, level: int = 1) -> bytes:
    raw = [a if isinstance(a, bytes) else a.tobytes() for a in arrays]
    head = np.array([len(raw), *map(len, raw)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=level).compress(head + b"".join(raw))


def unpack(blob: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    many = int(np.frombuffer(raw, np.int64, 1)[0])
    ends = np.cumsum(np.r_[8 * (many + 1), np.frombuffer(raw, np.int64, many, 8)])
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


def blocks_of(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """(block, blob) of about `block_bytes` of text; a document is never split."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0

        def block() -> pa.RecordBatch:
            lengths = np.array([len(t) for t in texts], np.int64)
            null = np.array([i is None for i in ids], bool)
            blob = pack(np.array([0 if i is None else i for i in ids], np.int64), null, lengths, b"".join(texts), level=3)
            return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 65]), pa.array([blob], pa.binary())], ["block", "blob"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
                ids.append(doc)
                texts.append(text.as_py() or b"")
                size += len(texts[-1]) + 64
                if size >= block_bytes:
                    yield block()
                    ids, texts, size = [], [], 0
        if ids:
            yield block()

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(step, "block long, blob binary")


class Block:
    """A block's documents and segments."""

    def __init__(self, blob: bytes, length: int, buckets: int):
        ids, null, sizes, self.data = unpack(blob)
        self.ids, self.null = np.frombuffer(ids, np.int64), np.frombuffer(null, bool)
        self.bounds = np.r_[0, np.cumsum(np.frombuffer(sizes, np.int64))]
        self.length = length
        self.first, self.many, least, self.ends = segments(np.frombuffer(self.data, np.uint8), self.bounds, length)
        self.doc = np.searchsorted(self.bounds, self.first, side="right") - 1
        self.rank = np.where(self.null, NO_ID, self.ids)  # what documents are compared by
        self.bucket, self.tag = placed(least, buckets)

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (bucket, tag) in order, and each segment's place among them."""
        return np.unique(self.bucket.astype(np.uint64) << np.uint64(32) | self.tag, return_inverse=True)

    def holders(self, place: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """How many further contents each distinct hash has here, and whether several documents have it."""
        low, high = np.full(count, len(self.ids)), np.full(count, -1)
        np.minimum.at(low, place, self.doc)
        np.maximum.at(high, place, self.doc)
        often = np.flatnonzero(np.bincount(place, minlength=count)[place] > 1)
        by = often[np.lexsort((self.ends[often], place[often]))]
        fresh = (place[by][1:] == place[by][:-1]) & (self.ends[by][1:] != self.ends[by][:-1])
        further = np.minimum(np.bincount(place[by][1:][fresh], minlength=count), LONG_MARK)
        further[place[self.many > LONG]] = LONG_MARK
        return further, low < high

    def pieces(self, flags: np.ndarray, buckets: int):
        """What the block sends, given each distinct hash's flag.

        Returns the segments that count (their places and contents' numbers), the
        contents' first segment, and the pieces: content, first byte, windows, bucket,
        tag, least and greatest rank of the documents that hold it, and bytes.
        """
        flag = flags[self.hashes()[1]]
        use = np.flatnonzero(flag > 0)
        known: dict[bytes, int] = {}
        ends = self.first[use] + self.many[use] + self.length - 1
        contents = [self.data[a:b] for a, b in zip(self.first[use].tolist(), ends.tolist())]
        of = np.array([known.setdefault(c, len(known)) for c in contents], np.int64)
        count = len(known)
        low, high = np.full(count, NO_ID), np.full(count, -NO_ID)
        np.minimum.at(low, of, self.rank[self.doc[use]])
        np.maximum.at(high, of, self.rank[self.doc[use]])
        sample = np.empty(count, np.int64)
        sample[of[::-1]] = use[::-1]
        split = flag[sample] == 2

        whole = np.flatnonzero(~split)
        texts = list(known)
        out = [(whole, np.zeros(len(whole), np.int64), self.many[sample[whole]], self.bucket[sample[whole]],
                self.tag[sample[whole]], low[whole], high[whole])]
        bodies = [texts[i] for i in whole.tolist()]
        window: dict[bytes, int] = {}
        cut = np.flatnonzero(split)
        owner = np.repeat(cut, self.many[sample[cut]])
        shift = ranges(np.zeros(len(cut), np.int64), self.many[sample[cut]])
        n = self.length
        number = np.fromiter(
            (window.setdefault(texts[i][j: j + n], len(window)) for i, j in zip(owner.tolist(), shift.tolist())),
            np.int64, len(owner),
        )
        if len(window):
            w_low, w_high = np.full(len(window), NO_ID), np.full(len(window), -NO_ID)
            np.minimum.at(w_low, number, low[owner])
            np.maximum.at(w_high, number, high[owner])
            rows = np.frombuffer(b"".join(window), np.uint8).reshape(-1, n).astype(np.uint64)
            weights = mixed(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
            own = mixed((rows * weights).sum(axis=1, dtype=np.uint64))
            bucket, tag = placed(own, buckets)
            one = np.ones(len(window), np.int64)
            out.append((-1 - np.arange(len(window)), 0 * one, one, bucket, tag, w_low, w_high))
            bodies += window
        columns = [np.concatenate(c) for c in zip(*out)]
        return use, of, columns, bodies, (owner, shift, number)


def placed(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32-bit tag of a hash. Equal tags of unequal hashes cost time, not correctness."""
    key = mixed(key + np.uint64(0x632BE59BD9B4E019))
    return ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), key & np.uint64(0xFFFFFFFF)


def least_holders(tags: np.ndarray, bodies: list[bytes], low: np.ndarray, length: int, most: int = SORTED) -> Iterator[tuple[int, np.ndarray]]:
    """(content, least rank per window) of contents that meet another one of their tag.

    bodies: distinct contents, `low` the least rank that holds each.
    """
    order = np.argsort(tags, kind="stable")
    starts = np.flatnonzero(np.r_[True, tags[order][1:] != tags[order][:-1]]) if len(order) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[starts, len(order)])
    lengths = np.array([len(b) for b in bodies], np.int64)
    groups = [order[s: s + k] for s, k in zip(starts.tolist(), sizes.tolist()) if k > 1]
    groups.sort(key=lambda g: int(lengths[g].sum()))  # strings of like length take like many steps
    for large in (False, True):
        batch, held = [], 0
        for g in groups:
            if (len(g) > most) != large:
                continue
            batch.append(g)
            held += int(lengths[g].sum())
            if held >= SORT_BYTES:
                yield from sorted_holders(batch, bodies, low, length, large)
                batch, held = [], 0
        if batch:
            yield from sorted_holders(batch, bodies, low, length, large)


def window_words(raw: np.ndarray, at: np.ndarray, length: int) -> list[np.ndarray]:
    """The windows at the given places as 8-byte words; the last word may overlap the one before."""
    x = raw.astype(np.uint64)
    for width in (1, 2, 4):
        x = x[:-width] | (x[width:] << np.uint64(8 * width))
    return [x[at + o] for o in [*range(0, length - 8, 8), length - 8]]


def sorted_holders(groups: list[np.ndarray], bodies: list[bytes], low: np.ndarray, length: int, large: bool):
    """Brings equal windows of each group together and yields (content, least rank per window).

    A group's contents form one string, joined by separators below all bytes that
    fall from left to right, whose suffixes are sorted. That takes as many steps as
    the longest string is long; large groups sort their windows by a hash of all
    their bytes instead. Either way neighbours are compared byte by byte.
    """
    content = np.concatenate(groups)
    sizes = np.array([len(bodies[c]) for c in content.tolist()], np.int64)
    in_group = np.array([len(g) for g in groups])
    group_of = np.repeat(np.arange(len(groups)), in_group)
    room = sizes + 1
    begin = np.cumsum(room) - room
    total = int(room.sum())
    raw = np.frombuffer(b"\0".join(bodies[c] for c in content.tolist()) + b"\0", np.uint8)
    piece = np.repeat(np.arange(len(content)), room)
    places = ranges(begin, sizes - length + 1)
    if large:
        words = window_words(raw, places, length)
        h = np.zeros(len(places), np.uint64)
        for w in words:
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + w)
        by = np.lexsort((h, group_of[piece[places]]))
        order = places[by]
    else:
        symbols = raw.astype(np.int32) + np.repeat(in_group[group_of], room)
        symbols[begin + sizes] = np.repeat(in_group, in_group) - 1 - ranges(np.zeros(len(groups), np.int64), in_group)
        bounds = np.r_[0, np.cumsum(np.bincount(group_of, weights=room).astype(np.int64))]
        is_window = np.zeros(total, bool)
        is_window[places] = True
        order = suffix_order(symbols, bounds)
        order = order[is_window[order]]
    views = np.lib.stride_tricks.sliding_window_view(raw, length)

    def equal_to_last(order: np.ndarray) -> np.ndarray:
        same = np.zeros(len(order), bool)
        for at in range(1, len(order), 1 << 16):
            to = min(len(order), at + (1 << 16))
            same[at:to] = (views[order[at:to]] == views[order[at - 1: to - 1]]).all(axis=1)
        same[1:] &= group_of[piece[order[1:]]] == group_of[piece[order[:-1]]]
        return same

    same = equal_to_last(order)
    if large and (~same[1:] & (h[by][1:] == h[by][:-1])).any():  # unequal windows of one hash may lie between equal ones
        order = places[np.lexsort((*words, group_of[piece[places]]))]
        same = equal_to_last(order)
    head = np.flatnonzero(~same)
    least = np.minimum.reduceat(low[content[piece[order]]], head) if len(order) else np.empty(0, np.int64)
    result = np.empty(total, np.int64)
    result[order] = np.repeat(least, np.diff(np.r_[head, len(order)]))
    for c, a, n in zip(content.tolist(), begin.tolist(), (sizes - length + 1).tolist()):
        yield c, result[a: a + n]


def compared(buckets: list[tuple[list[int], list[list[bytes]]]], length: int, most: int) -> pa.RecordBatch:
    """(block, blob): for each block's contents, runs of windows that an earlier document has, and the first such."""
    known: dict[tuple[int, bytes], int] = {}
    tags, read = [], []
    for at, (numbers, parts) in enumerate(buckets):
        for number, (content, many, tag, low, high, raw) in zip(numbers, parts):
            many = np.frombuffer(many, np.uint16).astype(np.int64)
            ends = np.cumsum(many + length - 1)
            of = np.empty(len(many), np.int64)
            for i, (a, b, t) in enumerate(zip((ends - many - length + 1).tolist(), ends.tolist(), np.frombuffer(tag, np.uint32).tolist())):
                of[i] = known.setdefault((at, raw[a:b]), len(known))
                if of[i] == len(tags):
                    tags.append(at << 32 | t)
            content = np.cumsum(np.frombuffer(content, np.int32), dtype=np.int64)
            read.append((number, content, many, of, np.frombuffer(low, np.int64), np.frombuffer(high, np.int64)))
    low = np.full(len(known), NO_ID)
    for _, _, _, of, own, _ in read:
        np.minimum.at(low, of, own)
    runs: dict[int, np.ndarray] = {}
    for c, least in least_holders(np.array(tags, np.int64), [body for _, body in known], low, length, most):
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        runs[c] = np.stack([first, np.diff(np.r_[first, len(least)]), least[first]], axis=1)
    has_runs = np.zeros(len(known), bool)
    has_runs[list(runs)] = True
    out = []
    for number, content, many, of, _, high in read:
        alone = np.flatnonzero(~has_runs[of] & (low[of] < high))
        rows = [np.stack([content[alone], 0 * alone, many[alone], low[of[alone]]], axis=1)]
        for i in np.flatnonzero(has_runs[of]).tolist():
            own = runs[int(of[i])]
            own = own[own[:, 2] < high[i]]
            if len(own):
                rows.append(np.c_[np.full(len(own), content[i]), own])
        found = np.concatenate(rows)
        if len(found):
            out.append((number, pack(found)))
    return records(["block", "blob"], [r[0] for r in out], [r[1] for r in out])


def per_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[int], list[bytes]]]:
    """(bucket, blocks, blobs) of a partition sorted by bucket, one bucket at a time."""
    bucket, blocks, blobs = None, [], []
    for batch in batches:
        for b, block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if b != bucket and blocks:
                yield bucket, blocks, blobs
                blocks, blobs = [], []
            bucket = b
            blocks.append(block)
            blobs.append(blob.as_py())
    if blocks:
        yield bucket, blocks, blobs


def records(names: list[str], *columns) -> pa.RecordBatch:
    types = [pa.binary() if n == "blob" else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50,
    block_bytes: int = 4 << 20, buckets: int | None = None, bucket_bytes: int = BUCKET_BYTES,
    sorted_contents: int = SORTED, many: int = MANY,
) -> DataFrame:
    """(id_col, n_bytes, spans, kept) for every row: what each text's UTF-8 bytes keep.

    Every byte goes that lies in a string of `length` bytes which also starts in a
    document with a smaller id; `spans` are the maximal removed runs (start, end) and
    `kept` the other bytes. Strings are judged on the input. Null texts count as
    empty; texts under `length` bytes keep all. Rows with equal ids do not remove each
    other's text; a null id counts as greater than all others. Other columns are
    ignored; an empty table gives an empty result.

    buckets: how finely hashes are dealt, by default one per `bucket_bytes` of text,
    eight per shuffle partition at least; a task holds one bucket at a time, of a
    size that does not grow with the input, and sees some eight. On large clusters raise
    `block_bytes`, so that a block still sends many hashes to each bucket. sorted_contents
    and many: see SORTED and MANY; all of these move work, not results.
    """
    if length < GRAM + 1:
        raise ValueError(f"length must be over {GRAM}")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = written_by(blocks_of(docs, id_col, text_col, block_bytes), "block", parts)
    buckets = buckets or max(BUCKETS_A_TASK * parts, blocks.count() * block_bytes // bucket_bytes)
    tasks = max(parts, buckets // BUCKETS_A_TASK)
    sent = ["bucket", "block", "blob"]

    def list_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = Block(blob.as_py(), length, buckets)
                distinct, place = block.hashes()
                further, several = block.holders(place, len(distinct))
                bucket = (distinct >> np.uint64(32)).astype(np.int64)
                first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
                ends = np.r_[first, len(bucket)]
                rows = []
                for a, b in zip(first, ends[1:].astype(int)):
                    tags = (distinct[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                    gaps = np.diff(tags, prepend=np.uint32(0))
                    rows.append((int(bucket[a]), pack(gaps, further[a:b].astype(np.uint16), several[a:b])))
                yield records(sent, [r[0] for r in rows], [number] * len(rows), [r[1] for r in rows])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, numbers, blobs in per_bucket(batches):
            parts = [unpack(b) for b in blobs]
            tags = [np.cumsum(np.frombuffer(p[0], np.uint32), dtype=np.uint32) for p in parts]
            distinct, place = np.unique(np.concatenate(tags), return_inverse=True)
            weigh = lambda k, kind: np.bincount(place, weights=np.concatenate([np.frombuffer(p[k], kind) for p in parts]))
            holders = np.bincount(place)
            frequent = weigh(1, np.uint16) + holders > many
            flag = np.where(holders + weigh(2, bool) < 2, 0, np.where(frequent, 2, 1)).astype(np.uint8)[place]
            ends = np.cumsum([len(t) for t in tags])[:-1]
            yield records(sent, [bucket] * len(numbers), numbers, [pack(x) for x in np.split(flag, ends)])

    def all_flags(rows) -> np.ndarray:
        return np.frombuffer(b"".join(unpack(r["blob"])[0] for r in sorted(rows, key=lambda r: r["bucket"])), np.uint8)

    def send_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob, rows in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                block = Block(blob.as_py(), length, buckets)
                _, _, (content, _, many, bucket, tag, low, high), bodies, _ = block.pieces(all_flags(rows.as_py() or []), buckets)
                order = np.argsort(bucket, kind="stable")
                first = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if len(order) else []
                out = []
                for a, b in zip(first, np.r_[first, len(order)][1:].astype(int)):
                    own = order[a:b]
                    out.append((int(bucket[own[0]]), pack(
                        np.diff(content[own], prepend=0).astype(np.int32), many[own].astype(np.uint16), tag[own].astype(np.uint32), low[own], high[own],
                        b"".join(bodies[i] for i in own.tolist()),
                    )))
                yield records(sent, [r[0] for r in out], [number] * len(out), [r[1] for r in out])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, numbers, blobs in per_bucket(batches):
            held.append((numbers, [unpack(b) for b in blobs]))
            size += sum(len(p[-1]) for p in held[-1][1])
            if size >= HELD_BYTES:
                yield compared(held, length, sorted_contents)
                held, size = [], 0
        yield compared(held, length, sorted_contents)

    result = f"`{id_col}` long, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary"

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, rows, found in zip(batch.column(1), batch.column(2), batch.column(3)):
                block = Block(blob.as_py(), length, buckets)
                use, of, _, _, windows = block.pieces(all_flags(rows.as_py() or []), buckets)
                spans, kept = marked(block, use, of, windows, [unpack(x)[0] for x in found.as_py() or []])
                yield pa.RecordBatch.from_arrays([
                    pa.array(block.ids, pa.int64(), mask=block.null), pa.array(np.diff(block.bounds), pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary()),
                ], [id_col, "n_bytes", "spans", "kept"])

    by_bucket = lambda df: df.repartition(*([tasks] if tasks > parts else []), "bucket").sortWithinPartitions("bucket")
    flags = by_bucket(blocks.mapInArrow(list_hashes, "bucket long, block long, blob binary")).mapInArrow(
        judge, "bucket long, block long, blob binary")
    flags = written(flags.groupBy("block").agg(F.collect_list(F.struct("bucket", "blob")).alias("flags")), "flags")
    judged = blocks.join(flags, "block", "left")
    found = by_bucket(judged.mapInArrow(send_pieces, "bucket long, block long, blob binary")).mapInArrow(
        compare, "block long, blob binary")
    found = written(found.groupBy("block").agg(F.collect_list("blob").alias("found")), "found")
    return judged.join(found, "block", "left").select("block", "blob", "flags", "found").mapInArrow(mark, result)


def marked(block: Block, use: np.ndarray, of: np.ndarray, windows, found: list[bytes]):
    """Each document's removed runs and remaining bytes."""
    owner, shift, number = windows
    rows = np.frombuffer(b"".join(found), np.int64).reshape(-1, 4)
    single = rows[rows[:, 0] < 0]
    rows = rows[rows[:, 0] >= 0]
    if len(single):  # windows that went one by one count for every content that holds them
        least = np.full(int(number.max()) + 1, NO_ID)
        least[-1 - single[:, 0]] = single[:, 3]
        hit = np.flatnonzero(least[number] < NO_ID)
        rows = np.concatenate([rows, np.stack([owner[hit], shift[hit], np.ones(len(hit), np.int64), least[number[hit]]], axis=1)])
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    begin, end = np.searchsorted(rows[:, 0], of), np.searchsorted(rows[:, 0], of, side="right")
    row = rows[ranges(begin, end - begin)]
    segment = np.repeat(use, end - begin)
    earlier = row[:, 3] < block.rank[block.doc[segment]]
    row, segment = row[earlier], segment[earlier]
    start = block.first[segment] + row[:, 1]
    size = len(block.data)
    depth = np.bincount(start, minlength=size + 1) - np.bincount(start + row[:, 2] + block.length - 1, minlength=size + 1)
    gone = np.cumsum(depth)[:size] > 0
    edge = np.flatnonzero(gone[1:] != gone[:-1]) + 1 if size else np.empty(0, np.int64)
    cuts = np.unique(np.r_[edge, block.bounds])
    spans, kept, at = [], [], 0
    for a, b in zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist()):
        own, parts = [], []
        while at + 1 < len(cuts) and cuts[at + 1] <= b and a < b:
            x, y = int(cuts[at]), int(cuts[at + 1])
            if gone[x]:
                own.append({"start": x - a, "end": y - a})
            else:
                parts.append(block.data[x:y])
            at += 1
        spans.append(own)
        kept.append(b"".join(parts))
    return spans, kept


def repeat_digests(removed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256) of `remove_repeats`."""
    return removed.select(
        id_col, "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
