"""The few steps that Spark has no expression for, as Arrow UDFs.

Each helper sees one Arrow batch of rows and keeps no state between batches, so
the work stays wherever Spark placed the rows.
"""

from __future__ import annotations

import html
import sys
import time
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from pithy.functions.porter import porter_stem

# Executors need not have this package installed: ship the code with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[porter_stem.__module__])


def nfkc(text: Column) -> Column:
    """Unicode NFKC. (Arrow's own kernel leaves accents decomposed.)"""

    @F.arrow_udf("string")
    def normalise(batch: pa.Array) -> pa.Array:
        return _by_row(lambda t: t and unicodedata.normalize("NFKC", t), pa.string(), batch)

    return normalise(text)


def unescape_entities(text: Column) -> Column:
    """Decode every entity, also the old names and numbers without `;`; anything else stays as it is."""

    @F.arrow_udf("string")
    def decode(batch: pa.Array) -> pa.Array:
        return _by_row(lambda t: t and html.unescape(t), pa.string(), batch)

    return decode(text)


def stem_tokens(tokens: Column) -> Column:
    """Porter-stem the tokens of a space-joined string that have over 3 characters.

    Each distinct token of a piece is looked up once; the strings are rebuilt from those.
    """

    @F.arrow_udf("string")
    def stem(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, str] = {}

        def stem_one(token: str) -> str:
            found = known.get(token)
            if found is None:
                if len(known) >= 50_000:  # bound the memory, not the result
                    known.clear()
                found = known[token] = porter_stem(token) if len(token) > 3 else token
            return found

        def stems(texts: pa.Array) -> pa.Array:
            lists = pc.split_pattern(texts.fill_null(""), " ")
            coded = lists.flatten().dictionary_encode()
            found = pa.array(map(stem_one, coded.dictionary.to_pylist()), pa.string()).take(coded.indices)
            joined = pc.binary_join(pa.ListArray.from_arrays(lists.offsets, found), " ")
            return pc.if_else(texts.is_valid(), joined, pa.scalar(None, pa.string()))

        for batch in batches:
            yield pa.concat_arrays([stems(texts) for (texts,) in _text_pieces(batch)] or [batch])

    return stem(tokens)


def lcs_length(reference: Column, candidate: Column) -> Column:
    """Length of the longest common subsequence of two space-joined token strings."""

    @F.arrow_udf("int")
    def lcs(left: pa.Array, right: pa.Array) -> pa.Array:
        return _by_row(lambda a, b: None if a is None or b is None else _lcs_bits(a.split(), b.split()), pa.int32(), left, right)

    return lcs(reference, candidate)


def union_lcs_hits(reference: Column, candidate: Column) -> Column:
    """ROUGE-Lsum hits of two token strings whose lines are the sentences."""

    @F.arrow_udf("int")
    def hits(left: pa.Array, right: pa.Array) -> pa.Array:
        return _by_row(lambda a, b: None if a is None or b is None else _union_hits(a, b), pa.int32(), left, right)

    return hits(reference, candidate)


def sentence_ranks(tokens: Column, damping: float, tol: float, max_iter: int) -> Column:
    """PageRank score of every sentence, from the sentences' weight tokens."""

    @F.arrow_udf("array<double>")
    def score(batch: pa.Array) -> pa.Array:
        return _batch_scores(batch, damping, tol, max_iter)

    return score(tokens)


def timed_sentence_ranks(tokens: Column, damping: float, tol: float, max_iter: int) -> Column:
    """(scores, seconds): as `sentence_ranks`, with each row's share of the time its batch took."""

    @F.arrow_udf("struct<scores: array<double>, seconds: double>")
    def score(batch: pa.Array) -> pa.Array:
        begin = time.perf_counter()
        scores = _batch_scores(batch, damping, tol, max_iter)
        share = (time.perf_counter() - begin) / max(1, len(batch))
        return pa.StructArray.from_arrays([scores, pa.array(np.full(len(batch), share))], ["scores", "seconds"])

    return score(tokens)


# Tokens that numpy handles at a time, in whole texts: bounds the scratch memory, not the result.
PIECE_TOKENS = 100_000


def _pieces(batch: pa.Array) -> Iterator[pa.Array]:
    """Runs of whole rows of an array<array<string>> batch, each of about PIECE_TOKENS tokens or one row."""
    upto = batch.values.offsets.to_numpy()[batch.offsets.to_numpy()]  # tokens before each row, and before the end
    for at, rows in _runs(upto, PIECE_TOKENS):
        yield batch.slice(at, rows)


# Bytes of text that become Python strings or tokens at a time, in whole texts: bounds the scratch memory, not the result.
PIECE_BYTES = 1_000_000


def _text_pieces(*columns: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
    """Runs of whole rows of string columns, each of about PIECE_BYTES or one row."""
    sizes = sum(pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    for at, rows in _runs(np.concatenate(([0], np.cumsum(sizes + 1))), PIECE_BYTES):
        yield tuple(c.slice(at, rows) for c in columns)


def _by_row(compute: Callable, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """What `compute` makes of each row's texts."""
    done = [pa.array([], kind)]
    for piece in _text_pieces(*columns):
        done.append(pa.array([compute(*row) for row in zip(*(c.to_pylist() for c in piece))], kind))
    return pa.concat_arrays(done)


def _runs(upto: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs whose sums are at most `most`, or of one row; upto: the sum before each row, and before the end."""
    at = 0
    while at < len(upto) - 1:
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + most, "right")) - 1)
        yield at, end - at
        at = end


def _coded(batch: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(sentences per row, sentence of each token, code of each token, the distinct tokens)."""
    sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
    sentences = batch.flatten()
    per_sentence = pc.list_value_length(sentences).to_numpy(zero_copy_only=False)
    words = sentences.flatten().dictionary_encode()
    sent = np.repeat(np.arange(len(per_sentence)), per_sentence)
    return sizes, sent, words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary


def _lists(lengths: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), values)


def _batch_scores(batch: pa.Array, damping: float, tol: float, max_iter: int) -> pa.Array:
    done = [pa.array([], pa.list_(pa.float64()))]
    for piece in _pieces(batch):
        sizes, sent, word, known = _coded(piece)
        scores = _rank_batch(sizes, sent, word, max(1, len(known)), damping, tol, max_iter)
        done.append(_lists(sizes, pa.array(scores, pa.float64())))
    return pa.concat_arrays(done)


CELLS = "array<struct<si: int, token: string, tf: bigint, df: bigint, weight: double>>"


def weight_cells(tokens: Column) -> Column:
    """The TF-IDF cells of every text, from its sentences' weight tokens: one per sentence and distinct token."""

    @F.arrow_udf(CELLS)
    def cells(batch: pa.Array) -> pa.Array:
        return pa.concat_arrays([_piece_cells(piece) for piece in _pieces(batch)] or [_piece_cells(batch)])

    return cells(tokens)


def _piece_cells(batch: pa.Array) -> pa.Array:
    sizes, sent, word, known = _coded(batch)
    doc, cell_sent, cell_word, tf, df, _, weight = _weigh(sizes, sent, word, max(1, len(known)))
    first = np.cumsum(sizes) - sizes  # sentences before those of a text
    cells = pa.StructArray.from_arrays([
        pa.array(cell_sent - first[doc[cell_sent]], pa.int32()), known.take(pa.array(cell_word)),
        pa.array(tf, pa.int64()), pa.array(df, pa.int64()), pa.array(weight, pa.float64()),
    ], ["si", "token", "tf", "df", "weight"])
    return _lists(np.bincount(doc[cell_sent], minlength=len(sizes)), cells)


def strength_of_sentences(cells: Column) -> Column:
    """Per text the sentences with a word that another one has, with their similarity to all others."""

    @F.arrow_udf("array<struct<si: int, value: double>>")
    def strength(batch: pa.Array) -> pa.Array:
        doc, si, term, df, weight = _cells(batch)
        shared = df > 1
        total = np.bincount(term, weight)
        return _by_sentence(len(batch), doc[shared], si[shared], (weight * (total[term] - weight))[shared])

    return strength(cells)


def similarity_of_sentences(cells: Column, anchor: int) -> Column:
    """Per text the sentences that share a word with its sentence `anchor`, with their similarity to that."""

    @F.arrow_udf("array<struct<si: int, value: double>>")
    def similarity(batch: pa.Array) -> pa.Array:
        doc, si, term, _, weight = _cells(batch)
        at = si == anchor
        of_anchor = np.full(int(term.max(initial=-1)) + 1, np.nan)
        of_anchor[term[at]] = weight[at]
        linked = ~at & ~np.isnan(of_anchor[term])
        return _by_sentence(len(batch), doc[linked], si[linked], (weight * of_anchor[term])[linked])

    return similarity(cells)


def _cells(batch: pa.Array) -> tuple[np.ndarray, ...]:
    """(row, sentence, number of the (row, token) pair, sentences with it, weight) of the cells of a batch."""
    sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
    si, token, df, weight = (batch.flatten().field(name) for name in ("si", "token", "df", "weight"))
    words = token.dictionary_encode()
    doc = np.repeat(np.arange(len(sizes)), sizes)
    term = np.unique(doc * max(1, len(words.dictionary)) + words.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
    return doc, si.to_numpy(zero_copy_only=False), term, df.to_numpy(zero_copy_only=False), weight.to_numpy(zero_copy_only=False)


def _by_sentence(rows: int, doc: np.ndarray, si: np.ndarray, share: np.ndarray) -> pa.Array:
    """The shares summed by row and sentence, as a list per row."""
    width = int(si.max(initial=0)) + 1
    keys, at = np.unique(doc * width + si, return_inverse=True)
    sums = pa.StructArray.from_arrays(
        [pa.array(keys % width, pa.int32()), pa.array(np.bincount(at, share, len(keys)), pa.float64())], ["si", "value"]
    )
    return _lists(np.bincount(keys // width, minlength=rows), sums)


def within_tokens(texts: list[str], tokenizer, most: int | None) -> list[str]:
    """The texts, each cut where its last allowed token ends; `tokenizer` is one of the `tokenizers` package."""
    if tokenizer is None or most is None:
        return texts
    found = tokenizer.encode_batch(texts, add_special_tokens=False)
    return [t if len(e.ids) <= most else t[: e.offsets[most - 1][1] if most else 0] for t, e in zip(texts, found)]


def _weigh(sizes, sent, word, n_words):
    """(document of a sentence; sentence, word, tf, df, number of the (document, word) pair and weight of a cell).

    sizes: sentences per document; sent, word: one entry per token. Cells are distinct
    (sentence, word); their weights are TF-IDF, L2-normalised by sentence.
    """
    doc = np.repeat(np.arange(len(sizes)), sizes)
    n = sizes[doc].astype(float)
    cells, tf = np.unique(sent * n_words + word, return_counts=True)
    cell_sent, cell_word = cells // n_words, cells % n_words
    _, term, df = np.unique(doc[cell_sent] * n_words + cell_word, return_inverse=True, return_counts=True)
    df = df[term]
    weight = tf * (np.log((1 + n[cell_sent]) / (1 + df)) + 1)
    weight /= np.sqrt(np.bincount(cell_sent, weight**2, len(doc)))[cell_sent]
    return doc, cell_sent, cell_word, tf, df, term, weight


def _rank_batch(sizes, sent, word, n_words, damping, tol, max_iter):
    """Power iteration over many documents at once, one block per document.

    sizes: sentences per document; sent, word: one entry per token. Similarity is
    the product of the TF-IDF matrix with its own transpose, diagonal removed; the
    product is never formed, so time and memory follow the tokens, not the pairs.
    """
    n_sent = int(sizes.sum())
    doc, cell_sent, _, _, df, term, weight = _weigh(sizes, sent, word, n_words)
    n = sizes[doc].astype(float)

    # A word of one sentence links nothing: dropping it leaves exact zeros.
    shared = df > 1
    cell_sent, term, weight = cell_sent[shared], term[shared], weight[shared]

    def neighbours(x):
        """Similarity matrix times x, without the sentence's own share."""
        own = weight * x[cell_sent]
        return np.bincount(
            cell_sent, weight * (np.bincount(term, own)[term] - own), len(x)
        )

    strength = neighbours(np.ones(n_sent))
    dangling = strength == 0
    x = 1 / n if n_sent else np.empty(0)
    scores, place = x.copy(), np.arange(n_sent)  # where the sentences at work came from
    active = np.ones(n_sent, bool)  # a converged document keeps its scores
    for step in range(max_iter):
        if not active.any():
            break
        if step % 4 == 0 and active.mean() < 0.7:  # converged documents leave
            scores[place[~active]] = x[~active]
            cells = active[cell_sent]
            cell_sent, weight = (np.cumsum(active) - 1)[cell_sent[cells]], weight[cells]
            term = np.unique(term[cells], return_inverse=True)[1]
            place, x, n, strength, dangling = place[active], x[active], n[active], strength[active], dangling[active]
            doc = np.unique(doc[active], return_inverse=True)[1]
            active = np.ones(len(x), bool)
        documents = int(doc[-1]) + 1
        spread = neighbours(np.divide(x, strength, out=np.zeros(len(x)), where=~dangling))
        lost = np.bincount(doc, x * dangling, documents)[doc] / n
        new = np.where(active, damping * (spread + lost) + (1 - damping) / n, x)
        change = np.bincount(doc, np.abs(new - x), documents)[doc]
        x, active = new, active & (change >= n * tol)
    scores[place] = x
    return scores


def _lcs_rows(a: list[str], b: list[str]) -> Iterator[int]:
    """Bit-parallel LCS: one big integer per prefix of b, a zero bit per matched place of a."""
    places: dict[str, int] = {}
    for i, token in enumerate(a):
        places[token] = places.get(token, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    yield row
    for token in b:
        match = row & places.get(token, 0)
        row = (row + match | row - match) & full
        yield row


def _lcs_bits(a: list[str], b: list[str]) -> int:
    for row in _lcs_rows(a, b):
        pass
    return len(a) - row.bit_count()


def _lcs_positions(a: list[str], b: list[str]) -> set[int]:
    """Positions in a of one longest common subsequence, ties walked as ROUGE walks them."""
    rows = list(_lcs_rows(a, b))

    def length(i: int, j: int) -> int:
        return i - (rows[j] & (1 << i) - 1).bit_count()

    found, i, j = set(), len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            found.add(i)
        elif length(i, j - 1) > length(i - 1, j):
            j -= 1
        else:
            i -= 1
    return found


def _union_hits(reference: str, candidate: str) -> int:
    """Tokens of the reference lines covered by any candidate line, each used once."""
    ref_lines = [line.split() for line in reference.split("\n") if line.strip()]
    cand_lines = [line.split() for line in candidate.split("\n") if line.strip()]
    ref_left = Counter(t for line in ref_lines for t in line)
    cand_left = Counter(t for line in cand_lines for t in line)
    hits = 0
    for line in ref_lines:
        covered = set().union(*(_lcs_positions(line, other) for other in cand_lines))
        for i in sorted(covered):
            token = line[i]
            if ref_left[token] > 0 and cand_left[token] > 0:
                ref_left[token] -= 1
                cand_left[token] -= 1
                hits += 1
    return hits
