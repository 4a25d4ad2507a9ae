"""Token counts of a unigram vocabulary without building the tokens."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pithy.llm.common import small_batches

SPACE = "▁"  # stands for a blank inside pieces
UNKNOWN_PENALTY = 10.0
CACHED = 500_000
CACHED_LENGTH = 64


def piece_scores(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece model file, in id order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounter:
    """Number of pieces on the best-scoring split of a text.

    An Aho-Corasick automaton lists the pieces that end at each character; the best
    score and the piece count of every prefix follow from shorter prefixes. Rules of
    the tokenizer: among splits of equal score, the longest last piece wins; a
    character without a piece of its own may be unknown, at the least score less 10;
    neighbouring unknown characters are one token, or one per UTF-8 byte if the
    vocabulary has a piece for every byte.

    Where pieces hold blanks only in front and scores are whole numbers, a text
    falls into words whose counts add up, and counts of recent words are kept.
    """

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        self.scores = dict(reversed(vocabulary))  # the first of equal pieces counts
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.bytewise = all(f"<0x{i:02X}>" in self.scores for i in range(256))
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.by_words = (
            self.bytewise and SPACE in self.scores
            and all(float(s).is_integer() for s in self.scores.values())
            and not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.scores)
        )
        self.words = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
        self.known: dict[str, int] = {}

    def best(self, text: str) -> tuple[int, float]:
        """Pieces and score of the best split, over the whole string."""
        score, count, unknown = [0.0], [0], [False]
        matches = self.automaton.iter(text) if self.scores else iter(())
        upcoming = next(matches, None)
        for end, char in enumerate(text):
            top = from_ = None
            single = False
            while upcoming is not None and upcoming[0] == end:  # longest first
                length, own = upcoming[1]
                single |= length == 1
                reached = score[end + 1 - length] + own
                if top is None or reached > top:
                    top, from_ = reached, end + 1 - length
                upcoming = next(matches, None)
            reached = score[end] + self.unknown
            if not single and (top is None or reached > top):
                score.append(reached)
                more = len(char.encode("utf-8", "surrogatepass")) if self.bytewise else int(not unknown[end])
                count.append(count[end] + more)
                unknown.append(True)
            else:
                score.append(top)
                count.append(count[from_] + 1)
                unknown.append(False)
        return count[-1], score[-1]

    def count(self, text: str | None) -> int:
        """Tokens of a text: a blank is put in front, as the tokenizer does; none if empty."""
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if not self.by_words:
            return self.best(text)[0]
        words = self.words.findall(text)
        try:
            return sum(map(self.known.__getitem__, words))
        except KeyError:
            pass
        if len(self.known) > CACHED:
            self.known.clear()
        total = 0
        for word in words:
            n = self.known.get(word)
            if n is None:
                n = self.best(word)[0]
                if len(word) <= CACHED_LENGTH:
                    self.known[word] = n
            total += n
        return total


@cache
def loaded(path: str) -> UnigramCounter:
    """One per Python worker, kept between tasks."""
    return UnigramCounter(piece_scores(path))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """(id_col, n_tokens, n_chars) for every row of `docs`; map-only, whole texts.

    The pieces and scores of the sentencepiece file `model` serve as the unigram
    vocabulary. Null and empty texts have no tokens. Repeated rows give one result
    row each, null ids stay null, an empty table gives an empty result, and other
    columns are ignored.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(model or default_model())
        for batch in batches:
            counts = [counter.count(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), batch.column(2)], schema.names)
        counter.known.clear()  # the worker lives on after the task

    small_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col), text.alias("text"), F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("n_chars"))
    schema = rows.selectExpr(f"`{id_col}`", "cast(0 as long) as n_tokens", "n_chars").schema
    return rows.mapInArrow(step, schema)
