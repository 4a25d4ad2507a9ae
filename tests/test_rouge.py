import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pithy.functions.arrays import compute_once, multiset_overlap, ngrams, numbered
from pithy.operators import evaluate as ev
from pithy.operators.rouge import VARIANTS, add_rouge, prepare_tokens
from pithy.operators.summarize import model_method


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, ref string, cand string")


def test_by_hand(spark):
    df = add_rouge(frame(spark, [("the cat sat on the mat", "the the cat ran"), ("", "x"), ("x", ""), (None, None)]),
                   "ref", "cand", stem=False)
    rows = df.orderBy("id").collect()
    r = rows[0]
    assert r["rouge1_precision"] == pytest.approx(3 / 4) and r["rouge1_recall"] == pytest.approx(3 / 6)
    assert r["rouge1_f1"] == pytest.approx(0.6)
    assert r["rouge2_precision"] == pytest.approx(1 / 3) and r["rouge2_recall"] == pytest.approx(1 / 5)
    assert r["rougeL_precision"] == pytest.approx(2 / 4) and r["rougeL_recall"] == pytest.approx(2 / 6)
    assert r["rougeLsum_f1"] == pytest.approx(r["rougeL_f1"])
    for r in rows[1:]:
        assert all(r[f"{v}_{p}"] == 0 for v in VARIANTS for p in ("f1", "precision", "recall"))


def test_stemming_only_for_longer_tokens(spark):
    df = frame(spark, [("running dogs was", "run dog wa"), ("relational", "relate")])
    stemmed = add_rouge(df, "ref", "cand", ["rouge1"], stem=True).orderBy("id").collect()
    plain = add_rouge(df, "ref", "cand", ["rouge1"], stem=False).orderBy("id").collect()
    assert stemmed[0]["rouge1_f1"] == pytest.approx(2 / 3)  # "was" has three letters and stays
    assert stemmed[1]["rouge1_f1"] == 1 and plain[1]["rouge1_f1"] == 0


def test_line_breaks_make_lsum_differ(spark):
    df = frame(spark, [("w1 w2 w3 w4 w5", "w1 w2 w6 w7 w8\nw1 w3 w8 w9 w5"), ("a b\nc d", "c d\na b")])
    for stem in (False, True):
        rows = add_rouge(df, "ref", "cand", ["rougeL", "rougeLsum"], stem=stem).orderBy("id").collect()
        assert rows[0]["rougeLsum_recall"] == pytest.approx(4 / 5)
        assert rows[1]["rougeLsum_f1"] == 1 and rows[1]["rougeL_f1"] == pytest.approx(0.5)


def test_counts_equal_counters_on_random_tokens(spark):
    rng = random.Random(3)
    rows = [([rng.choice("abcde") for _ in range(rng.randint(0, 30))],
             [rng.choice("abcdf") for _ in range(rng.randint(0, 30))]) for _ in range(200)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "id int, a array<string>, b array<string>")
    for n in (1, 2):
        got = df.select("id", multiset_overlap(numbered(ngrams(F.col("a"), n)), numbered(ngrams(F.col("b"), n))).alias("o"))
        for r in got.collect():
            a, b = (Counter(zip(*[side[k:] for k in range(n)])) for side in rows[r["id"]])
            assert r["o"] == sum((a & b).values())


def test_unknown_variant(spark):
    with pytest.raises(ValueError, match="Unknown ROUGE"):
        add_rouge(frame(spark, [("a", "b")]), "ref", "cand", ["rouge9"])


def test_score_methods(spark, corpus):
    rows = ev.score_methods(corpus, n=2)
    assert rows.columns == [
        "method", "article", "reference_summary", "generated_summary", "summary_length", "elapsed_seconds",
        *[f"{v}_{p}" for v in VARIANTS for p in ("f1", "precision", "recall")], "id", "source", "article_length",
    ]
    got = rows.collect()
    assert len(got) == 16 and {r["method"] for r in got} == {"lead_3", "textrank"}
    assert all(0 <= r["rouge1_f1"] <= 1 for r in got)
    capped = ev.score_methods(corpus, ["lead_3"], max_examples=3)
    assert capped.count() == 3
    summary = {r["method"]: r for r in ev.method_summary(rows).collect()}
    lead = [r for r in got if r["method"] == "lead_3"]
    assert summary["lead_3"]["rouge2"] == pytest.approx(sum(r["rouge2_f1"] for r in lead) / 8)
    assert summary["lead_3"]["n_examples"] == 8


def test_blank_articles_count_except_in_compression(spark):
    df = spark.createDataFrame([(1, "", "ref one"), (2, "Some words here. More words there. End.", "some words")],
                               "id long, article string, highlights string")
    (row,) = ev.method_summary(ev.score_methods(df, ["lead_3"], n=1)).collect()
    assert row["n_examples"] == 2 and row["mean_summary_length"] == 1.5
    assert row["mean_compression_ratio"] == pytest.approx(3 / 7)


def test_seconds_are_those_of_the_run(spark, corpus):
    """Every row and method has a time of its own; the summaries are the untimed ones."""
    def slow(model, texts):
        time.sleep(0.05 * len(texts))
        return ["model " + t[:9] for t in texts]

    methods = ["lead_3", "textrank", model_method("slow", lambda: None, slow, 2)]
    corpus = corpus.unionByName(corpus.limit(1).withColumn("article", F.lit(" ")))
    timed = ev.score_methods(corpus, methods, timed=True).collect()
    plain = ev.score_methods(corpus, methods).collect()
    key = lambda r: (r["method"], r["id"], r["article"])
    assert sorted((*key(r), r["generated_summary"], r["rouge1_f1"]) for r in timed) == sorted((*key(r), r["generated_summary"], r["rouge1_f1"]) for r in plain)
    assert all(r["elapsed_seconds"] == 0 for r in plain)
    assert all(0 < r["elapsed_seconds"] < 5 for r in timed if r["method"] != "slow")
    slow_ones = [r["elapsed_seconds"] for r in timed if r["method"] == "slow"]
    assert sum(s == 0 for s in slow_ones) == 1 and all(s >= 0.05 for s in slow_ones if s)
    means = {r["method"]: r["mean_inference_seconds"] for r in ev.method_summary(ev.score_methods(corpus, methods, timed=True)).collect()}
    assert means["slow"] > 0.04 > means["lead_3"] > 0

def test_compute_once_survives_the_optimizer(spark, corpus):
    """Sentences are split once in the plan, however often they are used."""
    df = ev.score_methods(corpus)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("?<=[.!?]") == 1
    assert "Exchange" not in plan and "Join" not in plan
    once = compute_once(spark.range(3), {"x": F.col("id") * 2})
    assert sorted(once.where("x > 0").collect()) == [(1, 2), (2, 4)]


def test_texts_of_a_row_are_stemmed_in_one_python_step(spark, corpus):
    """A task holds a Python worker per step: ranks, stems and subsequences, however many texts and variants."""
    for variants, steps in ((("rouge2",), 2), (tuple(VARIANTS), 3)):
        plan = ev.score_methods(corpus, variants=variants)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == steps


def test_tokens_made_before_give_the_same_scores(spark):
    rows = [("Cats sat.\nDogs ran ran.", "The cats sitting"), ("İt sat \x00 here", "sat\n\nİT here"), ("", "x\n"), (None, None), ("\n", "a")]
    df = frame(spark, rows)
    variants = tuple(VARIANTS)
    for stem in (True, False):
        made = prepare_tokens(df, [("ref", "_r"), ("cand", "_c")], variants, stem)
        scored = add_rouge(made, "ref", "cand", variants, stem, "_r", "_c")
        assert scored.columns == add_rouge(df, "ref", "cand", variants, stem).columns
        alone = add_rouge(df, "ref", "cand", variants, stem).orderBy("id").collect()
        assert scored.orderBy("id").collect() == alone
        one = prepare_tokens(df, [("ref", "_r")], variants, stem)
        assert add_rouge(one, "ref", "cand", variants, stem, "_r").orderBy("id").collect() == alone
