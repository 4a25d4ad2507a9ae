"""Quality checks, deduplication, splits, reports."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from pithy.operators import dedup, quality, reports, split, tfidf
from pithy.operators import evaluate as ev


def frame(spark, rows, schema="id long, source string, article string, highlights string"):
    return spark.createDataFrame(rows, schema)


MIXED = [
    (1, "a", "one two three", "one"), (2, "b", "  ", "x"), (3, None, None, "x"), (4, "a", "some words", " "),
    (5, "a", "short", "longer than it"), (6, "c", "two words", "same length"), (7, "a", "one two three", "one"),
    (8, "a", "one two three", None), (9, "a", "one two three", None),
]


def test_quarantine(spark):
    good, bad = quality.quarantine(frame(spark, MIXED))
    assert good.columns == ["id", "source", "article", "highlights"]
    assert sorted(r["id"] for r in good.collect()) == [1, 6, 7]
    assert {r["id"]: r["reject_reason"] for r in bad.collect()} == {
        2: "empty_article", 3: "empty_article", 4: "empty_summary", 5: "summary_longer_than_article",
        8: "empty_summary", 9: "empty_summary",
    }


def test_profile(spark, corpus):
    row = quality.profile(corpus).first()
    lengths = [len(r["article"].split()) for r in corpus.collect()]
    assert row["rows"] == 8 and row["sources"] == 2 and row["duplicate_rows"] == 0
    assert row["columns"] == ["id", "source", "article", "highlights"]
    a = row["article_lengths"]
    assert (a["min"], a["max"]) == (min(lengths), max(lengths))
    assert a["mean"] == pytest.approx(statistics.mean(lengths)) and a["median"] == statistics.median(lengths)
    assert a["mean"] > row["summary_lengths"]["mean"]


def test_duplicates_count_nulls_as_equal_and_empty_as_different(spark):
    rows = [*MIXED, (10, "a", "one two three", "")]
    assert quality.duplicate_count(frame(spark, rows)).first()[0] == 2  # 7 repeats 1, 9 repeats 8
    assert [r[0] for r in quality.distinct_sources(frame(spark, rows)).collect()] == ["a", "b", "c"]


def test_validate_order_and_messages(spark, corpus):
    with pytest.raises(quality.DataValidationError, match="No column named article or highlights"):
        quality.validate(spark.range(3))
    with pytest.raises(quality.DataValidationError, match="no rows"):
        quality.validate(corpus.where("false"))
    with pytest.raises(quality.DataValidationError, match="article column article, first ids: 2, 3"):
        quality.validate(frame(spark, MIXED))
    with pytest.raises(quality.DataValidationError, match="summary column .* first ids: 4, 8, 9"):
        quality.validate(frame(spark, MIXED).where("id not in (2, 3)"))
    with pytest.raises(quality.DataValidationError, match="swapped.*first ids: 5"):
        quality.validate(frame(spark, MIXED).where("id in (1, 5, 6)"))
    with pytest.warns(UserWarning, match="1 rows repeat"):
        quality.validate(frame(spark, MIXED).where("id in (1, 6, 7)"))  # equal lengths are allowed


def test_prepare(spark):
    df = frame(spark, [(1, "s", "<div>Old <i>mill</i> &mdash; closed.</div>", " a  b ")])
    (row,) = quality.prepare(df).collect()
    assert tuple(row) == (1, "s", "Old mill — closed.", "a b")


def test_deduplicate(spark):
    rows = [(3, "x", "Ships sail.", "c"), (2, "x", "fresh BREAD. ", "b"), (1, "x", "Fresh bread.", "a"),
            (4, "x", "  ", "d"), (5, "x", None, "e")]
    for parts in (1, 7):
        got = dedup.deduplicate(frame(spark, rows).repartition(parts)).orderBy("id").collect()
        assert [(r["id"], r["highlights"]) for r in got] == [(1, "a"), (3, "c")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_deduplicate_leaves_texts_in_place(spark):
    df = frame(spark, [(i, "s", "the same text" if i % 3 else f"text {i}", "h") for i in range(600)])
    result = dedup.deduplicate(df)
    assert result.count() == 201
    assert "BroadcastHashJoin" in plan_of(result) and "SortMergeJoin" not in plan_of(result)


def test_deduplicate_null_and_repeated_ids(spark):
    rows = [(None, "x", "One text", "b"), (1, "x", "one TEXT", "a"), (2, "x", "Two", "d"), (2, "x", "two ", "c"), (None, "y", "Three", "e")]
    got = dedup.deduplicate(frame(spark, rows)).collect()
    assert sorted((str(r["id"]), r["highlights"]) for r in got) == [("2", "d"), ("None", "b"), ("None", "e")]


def test_profile_and_best_worst_plans(spark, scored):
    df = frame(spark, MIXED)
    assert "Expand" not in plan_of(quality.profile(df))
    assert "SortAggregate" not in plan_of(reports.best_and_worst(scored))


def test_checks_are_made_once(spark):
    checked = quality.add_checks(frame(spark, MIXED))
    assert quality.add_checks(checked) is checked


def test_random_split(spark):
    for n in (4, 5, 10, 101, 1000):
        df = spark.range(n).repartition(3)
        a = {r["id"]: r["split"] for r in split.random_split(df).collect()}
        b = {r["id"]: r["split"] for r in split.random_split(df.repartition(11)).collect()}
        assert a == b and len(a) == n
        assert sum(s == "test" for s in a.values()) == -(-n // 4)
    other = {r["id"]: r["split"] for r in split.random_split(spark.range(1000), seed=7).collect()}
    assert other != a


def test_tiny_tables_are_split_like_others(spark):
    for n, test in ((0, 0), (1, 0), (2, 1), (3, 1)):
        got = split.random_split(spark.range(n)).collect()
        assert len(got) == n and sum(r["split"] == "test" for r in got) == test


def test_split_of_null_and_shared_ids(spark):
    nulls = spark.createDataFrame([(None, f"text {i}") for i in range(100)], "id long, article string")
    assert split.random_split(nulls).where("split = 'test'").count() == 25
    copies = spark.createDataFrame([(7, "x")] * 100, "id long, article string")
    assert {r["split"] for r in split.random_split(copies).collect()} == {"train"}
    hot = spark.createDataFrame([(7, "x")] * 40 + [(i, "y") for i in range(100, 160)], "id long, article string")
    got = split.random_split(hot).collect()
    assert len({r["split"] for r in got if r["id"] == 7}) == 1
    assert 0 < sum(r["split"] == "test" for r in got) < 100
    two = split.random_split(spark.createDataFrame([(1,)] * 5 + [(2,)] * 95, "id long")).collect()
    assert {r["split"] for r in two} == {"train", "test"}


def test_cap_leaves_rows_where_they_are(spark):
    capped = split.cap_rows(spark.range(10_000).repartition(8), 700)
    assert capped.count() == 700 and capped.rdd.getNumPartitions() == 8
    assert split.cap_rows(spark.range(5), 9).count() == 5
    assert split.cap_rows(spark.createDataFrame([(1,)] * 6 + [(2,)] * 6, "id long"), 8).count() == 6


def test_bucket_split_share(spark):
    share = split.bucket_split(spark.range(20_000)).where("split = 'test'").count() / 20_000
    assert share == pytest.approx(0.25, abs=0.02)


def test_explicit_split(spark):
    labels = [" Train", "TEST ", "val", "dev", "Validation", "other", None]
    df = spark.createDataFrame(list(enumerate(labels)), "id long, split string")
    got = {r["id"]: r["split"] for r in split.split_dataset(df).collect()}
    assert got == {0: "train", 1: "test", 2: "validation", 3: "validation", 4: "validation"}
    fallback = split.split_dataset(spark.range(40).withColumn("split", F.lit("test"))).collect()
    assert len(fallback) == 40 and sum(r["split"] == "test" for r in fallback) == 10


def test_cap(spark):
    df = spark.range(100)
    first = {r[0] for r in split.cap_rows(df, 7).collect()}
    assert first == {r[0] for r in split.cap_rows(df.repartition(9), 7).collect()} and len(first) == 7
    assert split.cap_rows(df, 0).count() == 100 and split.cap_rows(df, None).count() == 100


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(2)
    rows = [(m, i, rng.choice("xy"), 50 + i, 10 + rng.randint(0, 3), round(rng.choice([0.1, 0.25, 0.5]) + 0.01 * (m == "b"), 4))
            for m in ("a", "b") for i in range(40)]
    return spark.createDataFrame(
        rows, "method string, id long, source string, article_length int, summary_length int, rouge1_f1 double"
    ).cache()


def test_distribution(scored):
    got = {r["method"]: r for r in reports.score_distribution(scored, ["rouge1"]).collect()}
    for m in ("a", "b"):
        x = np.array([r["rouge1_f1"] for r in scored.collect() if r["method"] == m])
        r = got[m]
        assert r["mean"] == pytest.approx(x.mean()) and r["std"] == pytest.approx(x.std(ddof=1))
        assert [r["p25"], r["median"], r["p75"]] == pytest.approx(np.percentile(x, [25, 50, 75]))
        assert r["iqr"] == pytest.approx(r["p75"] - r["p25"])


def test_paired_and_best(scored):
    by = {(r["method"], r["id"]): r["rouge1_f1"] for r in scored.collect()}
    r = reports.paired_comparison(scored, "a", "b").first()
    assert r["left_wins"] == sum(by["a", i] > by["b", i] for i in range(40))
    assert r["right_wins"] == sum(by["a", i] < by["b", i] for i in range(40))
    assert r["left_wins"] + r["right_wins"] + r["ties"] == 40
    doubled = reports.paired_comparison(scored.union(scored), "a", "b").first()
    assert doubled["left_wins"] == 2 * r["left_wins"]  # copies count
    best = {r["method"]: r for r in reports.best_and_worst(scored).collect()}
    assert best["a"]["best_id"] == min(range(40), key=lambda i: (-by["a", i], i))
    assert best["a"]["worst_id"] == min(range(40), key=lambda i: (by["a", i], i))


def test_score_curve_expands_to_sorted_scores(scored):
    for m in ("a", "b"):
        runs = reports.score_curve(scored).where(F.col("method") == m).orderBy("from_position").collect()
        curve = [r["score"] for r in runs for _ in range(r["from_position"], r["to_position"] + 1)]
        assert curve == sorted((r["rouge1_f1"] for r in scored.collect() if r["method"] == m), reverse=True)
    with pytest.raises(ValueError):
        reports.score_curve(scored, "absent")


@pytest.mark.parametrize("counts", [[3, 5, 9, 40, 41, 100, 100], [7, 7, 7], [1, 2]])
def test_histogram_equals_numpy(spark, counts):
    df = spark.createDataFrame([("w " * c,) for c in counts], "t string")
    rows = reports.length_histogram(df, "t").orderBy("bin").collect()
    want, edges = np.histogram(counts, bins=20)
    assert [r["rows"] for r in rows] == want.tolist()
    assert [r["from_words"] for r in rows] == pytest.approx(edges[:-1])


def test_matrix_pivot_quality(spark, scored):
    summary = ev.method_summary(scored.withColumn("elapsed_seconds", F.lit(0.5)), ["rouge1"])
    assert summary.first()["mean_inference_seconds"] == 0.5
    long = {r["method"]: r["f1"] for r in reports.rouge_matrix(summary, ["rouge1"]).collect()}
    wide = {r["method"]: r["rouge1"] for r in reports.rouge_pivot(scored, ["rouge1"]).collect()}
    assert long == pytest.approx(wide)
    rows = reports.quality_by_characteristic(scored).collect()
    assert sum(r["rows"] for r in rows) == 80 and {r["length_band"] for r in rows} == {"000-099"}


def test_describe_and_skew(spark, corpus):
    got = {r["statistic"]: r for r in reports.describe_lengths(corpus).collect()}
    words = [len(r["article"].split()) for r in corpus.collect()]
    assert got["article_words"]["median"] == statistics.median(words) and got["sentence_count"]["min"] == 3
    skew = {r["split"]: r["rows"] for r in reports.split_skew(split.random_split(corpus)).collect()}
    assert skew == {"test": 2, "train": 6}


# --- plans ---

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def wide_documents(spark, tmp_path, corpus):
    corpus.write.parquet(str(tmp_path / "documents"))
    return spark.read.parquet(str(tmp_path / "documents"))


def test_a_split_reads_ids_alone(spark, wide_documents):
    cleaned = quality.prepare(wide_documents)
    plan = plan_of(split.random_split(cleaned).select("id", "split"))
    assert "ArrowEval" not in plan and "article" not in plan and "highlights" not in plan
    assert "sha2" not in plan_of(split.cap_rows(cleaned, 3))
    nulls = wide_documents.withColumn("id", F.when(F.col("id") > 4, F.col("id")))
    assert "sha2" in plan_of(split.random_split(nulls))


def test_weights_start_no_job_and_refuse_shared_ids(spark):
    df = spark.createDataFrame([(1, ["Some words here."]), (2, ["Other words."])], "id long, sentences array<string>")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("weights", "plan only")
    try:
        weights = tfidf.sentence_weights(df)
        assert list(tracker.getJobIdsForGroup("weights")) == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert weights.count() == 2
    for extra in (1, None):
        with pytest.raises(Exception, match="Not a unique id"):
            tfidf.sentence_weights(df.unionByName(df.limit(1).withColumn("id", F.lit(extra).cast("long")))).count()


def test_a_profile_reads_the_texts_once(spark, wide_documents):
    report = quality.profile(wide_documents)
    plan = plan_of(report)
    assert "documents" not in plan.replace("Location: InMemoryFileIndex", "") and report.first()["sources"] == 2


def test_blank_offenders_are_found_without_counting_words(spark):
    texts = [None, "", " \t\u00a0\u3000\n", "a", "a b c", "\u200b"]
    rows = [(i, texts[i % 6], texts[i // 6 % 6], None if i % 5 else "x") for i in range(72)]
    df = spark.createDataFrame(rows, "id long, article string, highlights string, _corrupt_record string")
    for given in (df, df.drop("_corrupt_record")):
        for reason in ("empty_article", "empty_summary"):
            found = quality.offenders(given, reason, n=100)
            assert [r.id for r in found.collect()] == [
                r.id for r in quality.add_checks(given).where(F.col("reject_reason") == reason).orderBy("id").collect()]
            assert "split(" not in plan_of(found)


def test_good_rows_take_no_full_word_count_of_the_article(spark):
    """They are those without a reason; the article is split up to as many words as the summary has."""
    words = ["", " ", "a", " a", "a ", "a b", "  a\t\nb ", "a b c", " a b c d", None]
    rows = [(i * 100 + j, "s", a, h) for i, a in enumerate(words) for j, h in enumerate(words)]
    df = frame(spark, rows)
    expected = quality.add_checks(df).where("reject_reason is null")
    good = quality.quarantine(df)[0]
    assert good.columns == df.columns and sorted(good.collect(), key=str) == sorted(expected.select(*df.columns).collect(), key=str)
    parsed = df.withColumn(quality.CORRUPT, F.when(F.col("id") % 2 == 0, "x"))
    assert {r["id"] for r in quality.quarantine(parsed)[0].collect()} == {r["id"] for r in expected.collect() if r["id"] % 2}
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "article_words" not in plan
    counted = df.withColumn("article_words", F.lit(7))
    assert {r["article_words"] for r in quality.quarantine(counted)[0].collect()} <= {1, 2, 3, 4}
