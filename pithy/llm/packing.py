"""Packing documents into fixed-size training sequences, best fit decreasing."""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pithy.llm.common import small_batches
from pithy.llm.suffixgroups import ranges
from pithy.session import written

END = 1
CAPACITY = 2048
SALTS = 1024
RANKS = 1 << 44
KEPT = 400_000
KEPT_LENGTH = 48
TOGETHER = 4 << 20

#: Fixed values of the tokenizer: how it cuts lower-cased text of ASCII and Latin letters.
RUNS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^\sa-zß-öø-ž0-9]+")
#: Text that has one normal form and is lower-cased letter by letter.
LATIN = re.compile("[ \n!-~\u00c0-\u012f\u0132-\u017e]*")
BLANKS = re.compile("[ \n\t]+")
#: The byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}


class TextIds:
    """Token ids of whole texts as little-endian uint32 bytes.

    The tokenizer drops white space and cuts lower-cased text into runs of letters,
    single digits and runs of signs, and the ids of the runs follow one another. Texts
    of printable ASCII and Latin letters are cut here, and the ids of the first words and
    runs of a task are kept; in other texts that goes for such words, and the rest goes to the tokenizer
    word by word.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def run(self, run: str) -> bytes:
        """Ids of one run; each byte stands as the character the byte-level alphabet gives it."""
        letters = run if run.isascii() else run.encode().decode("latin-1").translate(BYTE_LETTERS)
        return self.keep(self.runs, run, np.array([t.id for t in self.model.tokenize(letters)], "<u4").tobytes())

    def word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            lower = word.lower()
            if word.isalpha():
                return self.runs.get(lower) or self.run(lower)
            found = b"".join([self.runs.get(r) or self.run(r) for r in RUNS.findall(lower)])
            self.keep(self.words, word, found)
        return found

    def keep(self, known: dict[str, bytes], key: str, ids: bytes) -> bytes:
        if len(key) <= KEPT_LENGTH and len(known) < KEPT:  # what is frequent comes early
            known[key] = ids
        return ids

    def forget(self) -> None:
        """Gives the memory back at the end of a task; the worker lives on."""
        self.words.clear()
        self.runs.clear()

    def latin(self, texts: list[str]) -> list[bytes]:
        """Each distinct word is looked up once; the texts' ids are gathered from those."""
        words = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        distinct = list(map(self.word, coded.dictionary.to_pylist()))
        sizes = np.fromiter(map(len, distinct), np.int64, len(distinct)) // 4
        place = coded.indices.to_numpy()
        many = sizes[place]
        ids = np.frombuffer(b"".join(distinct), "<u4")[ranges((np.cumsum(sizes) - sizes)[place], many)]
        ends = np.r_[0, np.cumsum(many)][words.offsets.to_numpy()]
        return [ids[i:j].tobytes() for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def other(self, text: str) -> bytes:
        out = []
        for word in BLANKS.split(text):
            if LATIN.fullmatch(word) and "<|" not in word:
                out.append(self.word(word))
            else:
                out.append(np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes())
        return b"".join(out)

    def ids(self, texts: list[str]) -> list[bytes]:
        plain = [i for i, t in enumerate(texts) if LATIN.fullmatch(t) and "<|" not in t]
        out: list[bytes] = [b""] * len(texts)
        for i, ids in zip(plain, self.latin([texts[i] for i in plain])):
            out[i] = ids
        for i in set(range(len(texts))).difference(plain):
            out[i] = self.other(texts[i])
        return out


@cache
def loaded(path: str) -> TextIds:
    """One per Python worker, kept between tasks."""
    return TextIds(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def texts_ids(tokens: TextIds, texts: pa.Array) -> Iterator[bytes]:
    """The ids of every text, some megabytes of texts at a time."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= TOGETHER:
            yield from tokens.ids(held)
            held, size = [], 0
    yield from tokens.ids(held)


def pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, path: str | None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): full windows of each document, then the rest. Map-only."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = path or default_tokenizer()
        tokens = loaded(place)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), texts_ids(tokens, batch.column(1))):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start: 4 * (start + capacity)]
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), total))
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        tokens.forget()

    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(step, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


class OpenWindows:
    """Segment tree over the remaining capacity; a leaf holds the open windows with that much room, as runs."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.runs: list[deque[tuple[int, int]]] = [deque() for _ in range(capacity + 1)]

    def add(self, room: int, first: int, many: int, front: bool = False) -> None:
        (self.runs[room].appendleft if front else self.runs[room].append)((first, many))
        self._change(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self._change(room, -1)
        return self.runs[room].popleft()

    def _change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node //= 2

    def tightest(self, length: int) -> int | None:
        """The least room of at least `length` that an open window has."""
        node = length + self.size
        while not self.count[node]:
            while node & 1:  # a right child: go up until there is something to the right
                node //= 2
                if node <= 1:
                    return None
            node += 1
        while node < self.size:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        return node - self.size


def best_fit_decreasing(lengths: dict[int, int], capacity: int) -> np.ndarray:
    """Where best fit decreasing puts the pieces, by length and rank among pieces of that length.

    lengths: number of pieces of each length. Pieces of one length are alike, so
    windows are handled in runs of equal history: a run's windows with room r each
    take r // length pieces in turn, just as one-by-one placement would. Rows:
    length, first rank, first sequence, pieces per sequence, first offset. Their
    number depends on the capacity, not on the number of pieces.
    """
    tree, plan, opened = OpenWindows(capacity), [], 0
    for length in sorted((n for n in lengths if lengths[n]), reverse=True):
        left, rank = lengths[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, each = capacity, capacity // length
                first, many = opened, -(-left // each)
                opened += many
            else:
                first, many = tree.take(room)
                each = room // length
            plan.append((length, rank, first, each, capacity - room))
            used = min(left, many * each)
            full, rest = divmod(used, each)
            if many > full + bool(rest):
                tree.add(room, first + full + bool(rest), many - full - bool(rest), front=True)
            if full and room - each * length:
                tree.add(room - each * length, first, full)
            if rest:
                tree.add(room - rest * length, first + full, 1)
            left, rank = left - used, rank + used
    return np.array(plan, np.int64).reshape(-1, 5)


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece.

    A document's token ids, then the end id, are cut into full windows and a rest;
    pieces go, longest first, into the open window with the least room that holds
    them. Texts are tokenized once; after that only the pieces' numbers move. The
    driver sees one count per length (at most `capacity`) and makes the plan from
    it; a piece finds its place by its rank among pieces of its length. Ranks come
    from per-salt row numbers and sums of salt counts, so a frequent length is spread
    over SALTS tasks. Equal rows may swap places, which changes nothing.

    Null and empty texts are one end id. Repeated rows are packed each; null ids
    stay null. An empty table gives an empty result; other columns are ignored.
    """
    table = written(pieces(docs, id_col, text_col, capacity, tokenizer), "pieces")
    table = table.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SALTS)).cast("int"))
    counts = written(table.groupBy("length", "salt").count(), "piece-counts")
    plan = best_fit_decreasing(
        {r.length: r.n for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}, capacity
    )
    order = np.lexsort((plan[:, 1], plan[:, 0]))
    shared = docs.sparkSession.sparkContext.broadcast(plan[order])

    below = F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count")
    bases = counts.select("length", "salt", below.alias("base"))
    place = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens"))
    ranked = table.withColumn("rank", place.cast("long") - 1).join(bases, ["length", "salt"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("rank")).alias("rank")
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = shared.value
        keys = rules[:, 0] * RANKS + rules[:, 1]
        for batch in batches:
            length, rank = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            rule = rules[np.searchsorted(keys, length * RANKS + rank, side="right") - 1]
            turn = rank - rule[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(rule[:, 2] + turn // rule[:, 3]), pa.array(rule[:, 4] + turn % rule[:, 3] * length)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return ranked.mapInArrow(step, out)
