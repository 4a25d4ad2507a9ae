"""SimHash, embeddings and shared graph helpers against brute force."""

import random

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from pithy.llm import neardup, simhash
from pithy.llm.common import components, split_hot_groups
from pyspark.sql import functions as F


def reachable(count, linked):
    """Root of every row when rows i < j link where linked(i, j)."""
    root = list(range(count))
    for i in range(count):
        for j in range(i + 1, count):
            if linked(i, j):
                a, b = root[i], root[j]
                root = [a if r == b else r for r in root] if a != b else root
    return root


def plain_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    n = min(4, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i:i + 4]).encode(), seed=42).intdigest() for i in range(len(words) - n + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today"), (2, "the QUICK brown fox jumps over the lazy dog near the river bank today"),
    (3, None), (4, ""), (5, " \t\n "), (6, "one two"), (7, "one  two"), (8, "É one two three four"), (9, "x" * 5000), (9, "x" * 5000),
    (None, "one two"), (10, " ".join(f"w{i}" for i in range(3000))), (11, " ".join(f"w{i}" for i in range(2999)) + " changed"),
]


def test_simhash_components(spark):
    rows = TEXTS + [(100 + i, t + " extra") for i, (_, t) in enumerate(TEXTS) if t]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, fp string, root int")
    got = sorted((tuple(r) for r in simhash.simhash_components(docs).collect()), key=str)
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = reachable(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    least = {r: min((rows[i][0] for i in range(len(rows)) if roots[i] == r and rows[i][0] is not None), default=None) for r in set(roots)}
    want = sorted(((rows[i][0], f"{fps[i]:016x}", least[roots[i]]) for i in range(len(rows))), key=str)
    assert got == want


def test_simhash_of_an_empty_table(spark):
    assert simhash.simhash_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_gray_rank_orders_neighbours_one_bit_apart():
    codes = np.arange(64, dtype=np.uint64) ^ (np.arange(64, dtype=np.uint64) >> np.uint64(1))
    assert simhash.gray_rank(codes).tolist() == list(range(64))


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_index_finds_every_pair(radius):
    random.seed(radius)
    base = [random.getrandbits(64) for _ in range(30)]
    fps = np.array(sorted({b ^ sum(1 << random.randrange(64) for _ in range(random.randrange(5))) & (2**64 - 1) for b in base for _ in range(20)}), np.uint64)
    group = np.array([random.randrange(3) for _ in fps])
    order = np.lexsort((simhash.gray_rank(fps), group))
    fps, group = fps[order], group[order]
    found = {(int(i), int(j)) for a, b in simhash.linked_pairs(fps, group, radius) for i, j in zip(a, b)}
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if group[i] == group[j] and int(fps[i] ^ fps[j]).bit_count() <= radius}
    assert found == want


def test_links_cross_block_boundaries(spark):
    """A group above the block size still gives every component."""
    base = 0x0123456789ABCDEF
    fps = [base ^ (1 << i) for i in range(60)]
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    edges = simhash.fingerprint_links(df, radius=4, block=8)
    assert components(edges).select("root").distinct().count() == 1
    assert components(edges).count() == 59


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 50)}}


def test_split_groups_let_all_pairs_meet(spark):
    df = spark.range(50).select(F.lit(1).alias("k"), "id")
    dealt = split_hot_groups(df, ["k"], F.xxhash64("id"), 8).collect()
    tasks = {}
    for r in dealt:
        tasks.setdefault((r.block_a, r.block_b), set()).add(r.id)
    assert all(any({i, j} <= t for t in tasks.values()) for i in range(50) for j in range(i))


def embeddings(seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1):
        for _ in range(12):
            base = rng.normal(size=16)
            for _ in range(6):
                rows.append([float(x) for x in (base + rng.normal(size=16) * rng.choice([0, 0.05, 0.12, 0.3]))])
    return [(i, v, i % 2) for i, v in enumerate(rows)]


def test_embedding_components(spark):
    rows = embeddings()
    rows += [(900, rows[0][1], 0), (901, rows[0][1], None), (902, None, 0), (903, [0.0] * 16, 0), (904, [float("nan")] * 16, 0),
             (905, [None] + [1.0] * 15, 0), (906, [float("inf")] + [1.0] * 15, 0), (907, [], 0), (None, rows[0][1], 0),
             (908, [2 * x for x in rows[0][1]], 0), (909, [1e-300] * 16, 1), (910, [1e300] * 16, 1), (0, rows[0][1], 0), (911, [1.0] * 8, 1)]
    df = spark.createDataFrame([(i, v, l, "x") for i, v, l in rows], "vec_id long, embedding array<double>, label int, component string")
    got = sorted((tuple(r) for r in neardup.embedding_components(df, block=16).collect()), key=str)

    def vector(i):
        n, v, label = rows[i]
        if n is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v) / np.abs(v).max()
        return x / np.linalg.norm(x)

    vs = [vector(i) for i in range(len(rows))]
    linked = lambda i, j: vs[i] is not None and vs[j] is not None and rows[i][2] == rows[j][2] and len(vs[i]) == len(vs[j]) and vs[i] @ vs[j] >= 0.98
    roots = reachable(len(rows), linked)
    want = []
    for i, (n, _, _) in enumerate(rows):
        links = sum(1 for j in range(len(rows)) if j != i and linked(min(i, j), max(i, j)))
        component = min((rows[j][0] for j in range(len(rows)) if roots[j] == roots[i] and rows[j][0] is not None), default=None)
        want.append((n, links, component, n is not None and n == component))
    assert got == sorted(want, key=str)


def test_embedding_groups_above_the_block_at_full_width(spark):
    """One hot cluster of near copies over several blocks, small clusters and lone vectors in 64 dimensions."""
    rng = np.random.default_rng(5)
    hot = rng.normal(size=64) + rng.normal(size=(300, 64)) * 0.1
    small = (rng.normal(size=(60, 1, 64)) + rng.normal(size=(60, 5, 64)) * 0.13).reshape(-1, 64)
    x = np.r_[hot, small, rng.normal(size=(400, 64))].astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in neardup.embedding_components(df, block=64).collect()}
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    close = u @ u.T >= 0.98
    np.fill_diagonal(close, False)
    label = neardup.join_labels(np.arange(len(x)), *np.nonzero(close))
    assert got == {i: (int(close[i].sum()), int(label[i])) for i in range(len(x))}
    assert 100 < close[:300].sum(axis=1).mean() and 0 < (close[300:660].sum(axis=1) > 0).mean()


def test_pairs_count_in_the_first_bucket_they_share():
    last = neardup.LAST
    a = np.array([[-5, 2, 9], [2, 7, last], [3, last, last], [last] * 3])
    b = np.array([[-4, 2, 9], [-5, 7, 9], [3, 8, last], [last] * 3])
    assert neardup.shared_before(a, b, 9).tolist() == [True, True, True, False]
    assert neardup.shared_before(a, b, 7).tolist() == [True, False, True, False]
    assert neardup.shared_before(a, b, 2).tolist() == [False] * 4


def test_buckets_with_equal_members_are_one(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=64)
    rows = [(0, v.tolist()), (1, (v + 1e-9).tolist()), (2, rng.normal(size=64).tolist())]
    classes = spark.createDataFrame([(i, "x", 64, x, 1) for i, x in rows], "cid long, label string, width int, vector array<double>, many long")
    found = {r.cid: [g.bucket for g in r.groups] for r in neardup.shared_buckets(classes, 4, 3).collect()}
    pairs = [g for g in found[0] if g in found[1] and g not in found.get(2, [])]
    assert len(pairs) == 1 and set(found) <= {0, 1, 2}


def test_embedding_recall_at_the_threshold():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    x, y = neardup.probes(a), neardup.probes(0.98 * a + np.sqrt(1 - 0.98**2) * b)
    meet = [(neardup.bucket_keys(x[i:i + 1])[:, :, None] == neardup.bucket_keys(y[i:i + 1])[:, None, :]).any() for i in range(len(a))]
    assert np.mean(meet) > 0.999


def test_embeddings_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert neardup.embedding_components(empty).collect() == []


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 32))
    assert np.allclose(np.linalg.norm(neardup.hadamard(x), axis=1), np.sqrt(32) * np.linalg.norm(x, axis=1))


# --- the pipeline's stage ---

def edited_copies():
    """Texts with copies of few and of many scattered edits."""
    random.seed(12)
    rows = []
    for of in range(30):
        base = [f"v{random.randrange(4000)}" for _ in range(random.choice([6, 12, 40, 300, 1500]))]
        rows.append(" ".join(base))
        for share in (0.002, 0.02, 0.2):
            rows.append(" ".join(f"new{random.randrange(4000)}" if random.random() < share else w for w in base))
    rows += [rows[0].upper(), "", None, "one two", "one two three", "w " * 30, "w " * 3000, rows[4] + " \n"]
    return list(enumerate(rows))


def test_stage_keeps_one_of_each_group(spark):
    rows = edited_copies()
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = reachable(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()}
    assert kept == {min(k for k in range(len(rows)) if roots[k] == r) for r in set(roots)} and len(kept) < len(rows) - 30
