"""Top-k search, whitening and the filter audit against brute force."""

import random
import re
from itertools import permutations

import numpy as np
import pytest
from pithy.llm import audit, topk, whitening
from pithy.llm.queries import QUERIES
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, score string, row long, component int"


def rows_of(vectors):
    return [(i, v, 0, 7, "x", 1, 2) for i, v in vectors]


def floors(vector):
    if vector is None or not vector or any(x is None or not np.isfinite(x) for x in vector):
        return None
    return [int(np.floor(64 * x)) for x in vector]


# --- top k ---

def brute_top_k(vectors, k, every):
    usable = [(i, floors(v)) for i, v in vectors]
    usable = [(i, v) for i, v in usable if i is not None and v is not None and sum(x * x for x in v) < 2**60]
    out = []
    for at, (i, q) in enumerate(usable):
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, c)), j) for n, (j, c) in enumerate(usable) if n != at and len(c) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def ask(spark, vectors, every=5, **options):
    df = spark.createDataFrame(rows_of(vectors), SCHEMA).repartition(3)
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % every == 0, **options).collect())


def test_top_k_of_hard_rows(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(60)]
    vectors += [(100 + i, [0.5] * 8) for i in range(30)]  # ties
    vectors += [(5, [0.25] * 8), (5, [0.25] * 8), (None, [1.0] * 8), (200, None), (205, [float("nan")] * 8), (210, [None] + [1.0] * 7), (215, []),
                (220, [float("inf")] * 8), (225, [1.0] * 3), (230, [-1.0] * 3), (245, [1e300] * 8), (250, [0.0] * 8)]
    assert ask(spark, vectors, k=4, broadcast_bytes=1000, bins=100) == brute_top_k(vectors, 4, 5)
    assert ask(spark, vectors, k=1000) == brute_top_k(vectors, 1000, 5)


def test_top_k_of_large_components(spark):
    rng = np.random.default_rng(14)
    vectors = [(i, [float(x) for x in rng.normal(size=3) * 10.0 ** rng.integers(0, 8)]) for i in range(40)] + [(50, [1e15, 0.0, 0.0])]
    assert ask(spark, vectors, k=5, every=20, bins=1 << 16) == brute_top_k(vectors, 5, 20)


def test_top_k_blocks_meet(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 8]) for i in range(300)]  # many equal scores
    monkeypatch.setattr(topk, "ROW_BLOCK", 7)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    assert ask(spark, vectors, k=6) == brute_top_k(vectors, 6, 5)


def test_top_k_without_rows_or_queries(spark):
    assert ask(spark, []) == [] and ask(spark, [(1, [1.0]), (2, [1.0])]) == [] and ask(spark, [(0, [1.0])]) == []


# --- whitening ---

def whitened(spark, vectors, **options):
    return whitening.whiten(spark.createDataFrame(rows_of(vectors), SCHEMA).repartition(3), **options).collect()


def check_whitening(found, vectors, components=32):
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in vectors], dtype=object)
    n = len(x)
    off = n * x - x.sum(axis=0)
    deviation = (off**2).sum(axis=1)
    centred = off.astype(float) / n
    _, sizes, axes = np.linalg.svd(centred)
    values, axes = np.zeros(x.shape[1]), axes.T
    values[: len(sizes)] = sizes**2 / n  # the eigenvalues of the covariance
    rank = min(components, int((values > 1e-26 * values[0]).sum()))
    assert len(found) == n * rank
    at = {i: k for k, (i, _) in enumerate(vectors)}
    got = np.full((n, rank), np.nan)
    for r in found:
        assert r.n == n and r.deviation == deviation[at[r.vec_id]] and r.identity_error <= 1e-9
        assert abs(r.explained - values[r.component - 1] / values.sum()) <= 1e-9 * r.explained
        got[at[r.vec_id], r.component - 1] = r.whitened
    want = centred @ axes[:, :rank] / np.sqrt(values[:rank])
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < 1e-7


def test_whitening_equals_the_eigenvectors(spark):
    rng = np.random.default_rng(6)
    mix = rng.normal(size=(12, 12)) @ np.diag(2.0 ** -np.arange(12))
    vectors = [(i, [float(x) for x in rng.normal(size=12) @ mix]) for i in range(500)]
    check_whitening(whitened(spark, vectors), vectors)
    check_whitening(whitened(spark, vectors, components=3), vectors, 3)


def test_whitening_of_dependent_and_wide_ranging_dimensions(spark):
    rng = np.random.default_rng(7)
    vectors = []
    for i in range(200):
        a, b, c = (float(x) / 64 for x in rng.integers(-50, 50, 3))
        vectors.append((i, [a * 4096, b, a * 4096, c * 64, 0.5, b]))  # two copies and a constant
    check_whitening(whitened(spark, vectors), vectors)
    few = [(i, [float(x) for x in rng.normal(size=10)]) for i in range(4)]  # fewer rows than dimensions
    check_whitening(whitened(spark, few), few)


def test_whitening_of_hard_rows(spark):
    rng = np.random.default_rng(8)
    vectors = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(40)]
    bad = [(50, None), (51, []), (52, [None, 1.0, 1.0, 1.0]), (53, [float("nan")] * 4), (54, [float("-inf")] * 4), (55, [1.0] * 3), (56, [1e300] * 4)]
    check_whitening(whitened(spark, vectors + bad), vectors)
    twice = whitened(spark, [*vectors, (None, vectors[0][1]), vectors[0]])
    assert len(twice) == 42 * 4 and len({r.whitened for r in twice if r.vec_id in (None, 0) and r.component == 1}) == 1
    huge = whitened(spark, [(1, [1e12, 0.0]), (2, [-1e12, 3.0]), (3, [1e12, 5.0])])
    assert huge and all(r.deviation is None for r in huge)


def test_whitening_without_variance(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, [1.0, 2.0])]) == [] and whitened(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_shifted_factor_of_nearly_dependent_columns():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 6)) @ np.diag([1, 1e-2, 1e-4, 1e-6, 1e-8, 1e-10]) @ np.linalg.qr(rng.normal(size=(6, 6)))[0]

    def gram_of(factors):
        q = x
        for factor in factors:
            q = whitening.solved(q, factor)
        return q.T @ q

    sizes, directions = whitening.orthogonal_factor(gram_of, *x.shape)
    assert np.allclose(sizes, np.linalg.svd(x, compute_uv=False), rtol=1e-5) and np.allclose(directions.T @ directions, np.eye(6))


# --- filter audit ---

def brute_audit(docs, labels):
    texts, fails = {}, []
    for i, text, _ in docs:
        if i is not None:
            texts[text or ""] = min(i, texts.get(text or "", i))
    for i, text, _ in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails.append("".join(f for f, failed in {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": i is not None and i > texts[text],
        }.items() if failed))
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    out, shapley = [], {}
    for part in {s or "" for *_, s in docs}:
        of = [(i, f) for (i, _, s), f in zip(docs, fails) if (s or "") == part]
        for order in permutations("ABCDE"):
            for step, f in enumerate(order):
                gone = [d for d in of if set(order[:step]) & set(d[1])]
                left = [d for d in of if not set(order[:step]) & set(d[1])]
                removed = [d for d in left if f in d[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(removed)
                out.append((part, "".join(order), step + 1, len(left) - len(removed), len(removed), sum(f in d[1] for d in gone),
                            sum(d[1] == f for d in of), sum(d[0] in good for d in removed), sum(d[0] in toxic for d in removed)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(spark, docs, labels):
    df = spark.createDataFrame([(*d, "k", 3) for d in docs], "doc_id long, text string, source string, key string, part int")
    marks = spark.createDataFrame([(*m, "d") for m in labels], "doc_id long, quality int, toxic int, digest string")
    return sorted(tuple(r) for r in audit.audit_filters(df.repartition(3), marks).select(COLUMNS).collect())


def test_audit_of_hard_rows(spark, monkeypatch):
    random.seed(10)
    pool = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(random.choice(pool[: random.choice([30, 400])]) for _ in range(random.choice([10, 49, 50, 120])))
             + random.choice(["", " #", " A|", "  x \x0b\x0c"]) + "Q" * random.choice([0, 40]), random.choice(["a", "a", "a", "b", None, ""])) for i in range(150)]
    docs += [(200 + i, docs[i][1], "c") for i in range(40)] + [docs[3], docs[4], (None, docs[5][1], "a"), (300, None, "a"), (301, "", "b"), (302, None, None),
             (303, "x" * 300_000, "a"), (304, "É" * 60 + " \n" + "Z" * 3, "d")]
    labels = [(i, random.choice([0, 1, None]), random.choice([0, 1])) for i in range(0, 320, 2)] + [(None, 1, 1), (4, 1, 0), (4, 0, 1), (999, 1, 1)]
    want = brute_audit(docs, labels)
    assert audited(spark, docs, labels) == want
    monkeypatch.setattr(audit, "RANGE_BITS", 3)
    assert audited(spark, docs, labels) == want


def test_audit_of_clean_and_empty_tables(spark):
    assert audited(spark, [], []) == []
    rows = audited(spark, [(1, " ".join(f"v{i}" for i in range(60)), "s")], [])
    assert len(rows) == 600 and all(r[3] == 1 and not any(r[4:]) for r in rows)


@pytest.mark.parametrize("seed", range(5))
def test_galloping_merges(seed):
    random.seed(seed)
    lists = [sorted(random.sample(range(300), random.choice([0, 1, 5, 60, 250]))) for _ in range(5)]
    lists.append(list(range(100, 140)))
    assert audit.union(lists) == sorted(set().union(*lists))
    for ids in lists:
        others = [o for o in lists if o is not ids]
        assert audit.difference(ids, others) == sorted(set(ids) - set().union(*others)) and audit.difference(ids, [ids]) == []
        assert [audit.gallop(ids, 0, b) for b in (0, 50, 299, 400)] == [sum(i < b for i in ids) for b in (0, 50, 299, 400)]


def test_queries_of_statistics_match_their_tables(spark):
    sf = "/root/testdata/sf0.001"
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert QUERIES["op12_embedding_whitening"](spark, sf).count() == 32 * vectors
    assert QUERIES["op11_exact_top_k"](spark, sf).count() == 20 * len(range(0, vectors, 20))
