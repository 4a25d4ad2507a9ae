"""Arrow helpers against plain definitions."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from pithy.functions.arrow_udfs import _lcs_bits, _lcs_positions, _rank_batch, _union_hits
from pithy.functions.porter import porter_stem

words = st.lists(st.sampled_from("abcd"), max_size=12)


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@given(words, words)
def test_lcs_bits(a, b):
    assert _lcs_bits(a, b) == lcs(a, b)
    assert _union_hits(" ".join(a), " ".join(b)) == lcs(a, b)


@given(words, words)
def test_lcs_positions_are_a_common_subsequence(a, b):
    at = sorted(_lcs_positions(a, b))
    rest = iter(b)
    assert len(at) == lcs(a, b) and all(a[i] in rest for i in at)


def test_lcs_positions_of_long_lines():
    a, b = ([f"w{i * k % 997}" for i in range(4000)] for k in (1, 7))
    assert len(_lcs_positions(a, b)) == _lcs_bits(a, b)


def test_union_lcs_example():
    """The example of Lin (2004): one reference line, two candidate lines."""
    assert _union_hits("w1 w2 w3 w4 w5", "w1 w2 w6 w7 w8\nw1 w3 w8 w9 w5") == 4


@pytest.mark.parametrize(("word", "stem"), [
    ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"), ("feed", "feed"),
    ("agreed", "agre"), ("plastered", "plaster"), ("bled", "bled"), ("motoring", "motor"), ("sing", "sing"),
    ("conflated", "conflat"), ("troubled", "troubl"), ("sized", "size"), ("hopping", "hop"), ("falling", "fall"),
    ("hissing", "hiss"), ("failing", "fail"), ("filing", "file"), ("happy", "happi"), ("sky", "sky"),
    ("enjoy", "enjoy"), ("relational", "relat"), ("conditional", "condit"), ("rational", "ration"),
    ("vietnamization", "vietnam"), ("predication", "predic"), ("operator", "oper"), ("feudalism", "feudal"),
    ("decisiveness", "decis"), ("hopefulness", "hope"), ("formaliti", "formal"), ("sensibiliti", "sensibl"),
    ("triplicate", "triplic"), ("formative", "form"), ("electrical", "electr"), ("goodness", "good"),
    ("revival", "reviv"), ("allowance", "allow"), ("inference", "infer"), ("adjustable", "adjust"),
    ("replacement", "replac"), ("adoption", "adopt"), ("communism", "commun"), ("effective", "effect"),
    ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"), ("controll", "control"), ("roll", "roll"),
    ("dying", "die"), ("news", "news"), ("died", "die"), ("cried", "cri"), ("is", "is"),
])
def test_porter(word, stem):
    assert porter_stem(word) == stem


def dense_pagerank(sentences):
    """Textbook form: full similarity matrix, one document."""
    vocabulary = sorted({t for s in sentences for t in s})
    n = len(sentences)
    tf = np.array([[s.count(t) for t in vocabulary] for s in sentences], float).reshape(n, -1)
    df = (tf > 0).sum(axis=0)
    m = tf * (np.log((1 + n) / (1 + df)) + 1)
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    m = np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)
    sim = m @ m.T
    np.fill_diagonal(sim, 0)
    out = sim.sum(axis=1)
    x = np.full(n, 1 / n)
    for _ in range(200):
        new = np.full(n, 0.15 / n) + 0.85 * x[out == 0].sum() / n
        for i in range(n):
            if out[i] > 0:
                new += 0.85 * x[i] * sim[i] / out[i]
        done = np.abs(new - x).sum() < n * 1e-4
        x = new
        if done:
            break
    return x


def rank(documents):
    sizes = np.array([len(d) for d in documents])
    sentences = [s for d in documents for s in d]
    sent = np.repeat(np.arange(len(sentences)), [len(s) for s in sentences]).astype(np.int64)
    codes = pa.array([t for s in sentences for t in s], pa.string()).dictionary_encode()
    return _rank_batch(sizes, sent, codes.indices.to_numpy().astype(np.int64), max(1, len(codes.dictionary)), 0.85, 1e-4, 200)


def test_rank_batch_equals_dense_form():
    rng = random.Random(5)
    documents = [
        [[rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 6))] for _ in range(rng.randint(0, 14))]
        for _ in range(60)
    ]
    documents += [[["a"]], [["a"], ["b"], ["c"]], [[], []], [["a", "b"]] * 5, []]
    got, at = rank(documents), 0
    for d in documents:
        part = got[at : at + len(d)]
        at += len(d)
        if d:
            assert np.allclose(part, dense_pagerank(d), atol=1e-12)
            assert math.isclose(part.sum(), 1, abs_tol=1e-9)


def test_rank_does_not_depend_on_batch_neighbours():
    a, b = [["x", "y"], ["y"], ["z"], ["x"]], [["x"], ["y", "x"], ["q"]]
    together = rank([a, b])
    assert np.array_equal(together, np.concatenate([rank([a]), rank([b])]))


def test_large_document_stays_linear():
    """20,000 sentences that all share a word: their pairs would be 400 million."""
    scores = rank([[["common", f"w{i % 5000}"] for i in range(20_000)]])
    assert len(scores) == 20_000 and math.isclose(scores.sum(), 1, abs_tol=1e-6)


def test_ranks_and_cells_do_not_depend_on_the_pieces(monkeypatch):
    from pithy.functions import arrow_udfs
    rows = [[["a", "b"], ["b", "c"], []], None, [], [["a", "a", "d"], ["d"]], [["b"], ["b"], ["c", "b"]]] * 3
    batch = pa.array(rows, pa.list_(pa.list_(pa.string())))
    made = []
    for tokens in (100_000, 3, 1):
        monkeypatch.setattr(arrow_udfs, "PIECE_TOKENS", tokens)
        pieces = list(arrow_udfs._pieces(batch.slice(2)))
        assert sum(len(p) for p in pieces) == len(batch) - 2 and (tokens > 3 or len(pieces) > 3)
        cells = pa.concat_arrays([arrow_udfs._piece_cells(p) for p in pieces]).to_pylist()
        scores = arrow_udfs._batch_scores(batch.slice(2), 0.85, 1e-4, 200).to_pylist()
        made.append((cells, scores))
    assert len(made[0][0]) == len(batch) - 2
    for cells, scores in made[1:]:
        assert [[(c["si"], c["token"], c["tf"], c["df"], round(c["weight"], 9)) for c in row] for row in cells] == [
            [(c["si"], c["token"], c["tf"], c["df"], round(c["weight"], 9)) for c in row] for row in made[0][0]]
        assert [[round(s, 9) for s in row] for row in scores] == [[round(s, 9) for s in row] for row in made[0][1]]
