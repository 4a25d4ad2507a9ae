import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pithy.functions import arrow_udfs, text
from pithy.operators import summarize as S
from pithy.operators import tfidf
from pithy.session import BATCH_BYTES, BATCH_ROWS, job, small_batches

ARTICLE = (
    "The harbour bridge opened after two years of work. Engineers tested the bridge with heavy lorries. "
    "The mayor thanked the engineers. Ferries stop running next month. A museum about the bridge is planned."
)


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, article string")


def test_effective_n(spark):
    df = spark.range(0, 60).select(F.col("id").cast("int").alias("t"))
    for requested in (-1, 0, 1, 2, 3, 10, 100):
        for r in df.select("t", S.effective_n(requested, F.col("t")).alias("n")).collect():
            t = r["t"]
            want = 1 if t <= 1 else max(1, min(requested, max(1, round(t * 0.6)), max(1, t - 1)))
            assert r["n"] == want, (requested, t)


def test_lead(spark):
    rows = S.summarize(texts(spark, ARTICLE, "One only.", "", None, "A b. C d."), "lead_3", 2).orderBy("id").collect()
    assert rows[0]["summary"].endswith("heavy lorries.") and rows[0]["summary"].startswith("The harbour")
    assert [r["summary"] for r in rows[1:]] == ["One only.", "", "", "A b."]
    assert [r["short_input"] for r in rows] == [False, True, True, True, True]


def test_textrank_takes_source_sentences_in_order(spark):
    (row,) = S.summarize(texts(spark, ARTICLE), "textrank", 2).collect()
    picked = [s for s in ARTICLE.split(". ") if s.rstrip(".") in row["summary"]]
    assert len(picked) == 2 and row["summary"].index(picked[0]) < row["summary"].index(picked[1][:20])


def test_textrank_edge_cases(spark):
    same = " ".join(["Equal words here."] * 5)
    df = texts(spark, "It is. He was. They are. We were. You can.", same, "Solo sentence.", "", "Alpha. Beta.")
    rows = [r["summary"] for r in S.summarize(df, "textrank").orderBy("id").collect()]
    assert rows[0] == "It is. He was. They are."  # stop words only: lead sentences
    assert rows[1] == " ".join(["Equal words here."] * 3)  # ties: the earlier ones
    assert rows[2:] == ["Solo sentence.", "", "Alpha."]


def test_results_do_not_depend_on_partitions_or_repeated_ids(spark):
    df = spark.createDataFrame([(1, ARTICLE), (1, ARTICLE), (1, "A b c. B c d. C d e. X y.")], "id long, article string")
    one, many = (
        sorted(r["summary"] for r in S.summarize(df.repartition(n), "textrank").collect()) for n in (1, 16)
    )
    assert one == many and len(one) == 3 and one.count(one[1]) == 2


def test_dispatch_errors_come_before_any_job(spark):
    with pytest.raises(ValueError, match="no method 'nope'"):
        S.summarize(texts(spark, ARTICLE), "nope")
    with pytest.raises(ValueError, match="at least one method"):
        S.choose_methods([])
    assert [m.name for m in S.choose_methods()] == ["lead_3", "textrank"]


def test_model_hook(spark):
    def load():
        return {"suffix": "!"}

    def predict(model, articles):
        assert 0 < len(articles) <= 2
        return [a.split(" ")[0] + model["suffix"] for a in articles]

    method = S.model_method("stub", load, predict, batch_size=2)
    df = texts(spark, "One two", "", None, "Three four", "Five", "Six seven").coalesce(1)
    rows = S.summarize(df, method).orderBy("id").collect()
    assert [r["summary"] for r in rows] == ["One!", "", "", "Three!", "Five!", "Six!"]
    assert not any(r["short_input"] for r in rows)


def sentence_table(spark):
    df = texts(spark, ARTICLE, "Alpha beta. Beta gamma. Delta alone.", "", "Only one here.")
    return df.select("id", text.split_sentences(F.col("article")).alias("sentences"))


def test_weights_table_by_hand(spark):
    import math
    rows = {(r["id"], r["si"], r["token"]): r for r in tfidf.sentence_weights(sentence_table(spark)).collect()}
    beta, alpha = math.log(4 / 3) + 1, math.log(4 / 2) + 1
    got = rows[(1, 0, "beta")]
    assert (got["tf"], got["df"], got["n_sentences"]) == (1, 2, 3)
    assert got["weight"] == pytest.approx(beta / math.hypot(beta, alpha))
    assert rows[(3, 0, "one")]["df"] == 1


def test_similarity_tables_agree_with_pairs(spark):
    weights = tfidf.sentence_weights(sentence_table(spark)).cache()
    vectors = {}
    for r in weights.collect():
        vectors.setdefault((r["id"], r["si"]), {})[r["token"]] = r["weight"]

    def cosine(a, b):
        return sum(w * b.get(t, 0) for t, w in a.items())

    strength = {(r["id"], r["si"]): r["strength"] for r in tfidf.sentence_strength(weights).collect()}
    lead = {(r["id"], r["si"]): r["similarity"] for r in tfidf.similarity_to(weights).collect()}
    for key, vector in vectors.items():
        others = [v for k, v in vectors.items() if k[0] == key[0] and k != key]
        assert strength.get(key, 0) == pytest.approx(sum(cosine(vector, v) for v in others))
        if key[1]:
            assert lead.get(key, 0) == pytest.approx(cosine(vector, vectors[(key[0], 0)]))


def test_weights_are_computed_in_their_rows(spark):
    """One shuffle and one sort, of texts and not of words; packed and long tables say the same."""
    df = sentence_table(spark)
    packed = tfidf.sentence_weights(df, packed=True)
    weights = tfidf.sentence_weights(df)
    for made in (weights, tfidf.sentence_strength(packed), tfidf.similarity_to(packed)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1 and "Aggregate" not in plan
    long = weights.localCheckpoint()
    for of in (tfidf.sentence_strength, tfidf.similarity_to):
        one, two = ({(r[0], r[1]): r[2] for r in of(w).collect()} for w in (packed, long))
        assert one and one == pytest.approx(two)
    assert [(c, t) for c, t in weights.dtypes] == [
        ("id", df.dtypes[0][1]), ("n_sentences", "int"), ("si", "int"), ("token", "string"), ("tf", "bigint"), ("df", "bigint"), ("weight", "double")]


def test_null_and_empty_sentences_weigh_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [None, "Alpha beta.", "Beta beta."]), (4, ["the of"])], "id long, sentences array<string>")
    rows = {(r["id"], r["si"], r["token"]): (r["tf"], r["df"]) for r in tfidf.sentence_weights(df).collect()}
    assert rows == {(3, 1, "alpha"): (1, 1), (3, 1, "beta"): (1, 2), (3, 2, "beta"): (2, 2)}


def test_summaries_go_to_python_in_small_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    try:
        S.add_summaries(texts(spark, ARTICLE))
        assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_long_texts_go_to_python_few_at_a_time(spark):
    """1,000 texts of 100 KB would be 100 MB in every worker: a batch is bounded in bytes as well."""
    with job(spark):
        spark.conf.set(BATCH_ROWS, 10_000)
        spark.conf.set(BATCH_BYTES, "64m")
        S.add_summaries(texts(spark, ARTICLE))
        long = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("t"))
        rows_of_batch = F.arrow_udf(lambda batch: pa.array([len(batch)] * len(batch), pa.int64()), "long")
        sizes = [r[0] for r in long.select(rows_of_batch("t")).collect()]
        assert len(sizes) == 300 and max(sizes) <= 100
        spark.conf.set(BATCH_BYTES, "1m")
        small_batches(spark)
        assert spark.conf.get(BATCH_BYTES) == "1m"


def test_pieces_of_a_batch_give_the_same_texts(monkeypatch):
    values = ["ﬁ", None, "", "a" * 50, "½ café", "b"] * 3
    whole = [v and unicodedata.normalize("NFKC", v) for v in values]
    for size in (1, 20, 10**6):
        monkeypatch.setattr(arrow_udfs, "PIECE_BYTES", size)
        array = pa.array(["dropped", *values]).slice(1)
        assert arrow_udfs._by_row(lambda t: t and unicodedata.normalize("NFKC", t), pa.string(), array).to_pylist() == whole
        assert sum(len(piece) for (piece,) in arrow_udfs._text_pieces(array)) == len(values)
        assert arrow_udfs._by_row(lambda a, b: None, pa.int32(), array.slice(0, 0), array.slice(0, 0)).to_pylist() == []


def test_default_stop_words_are_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover
    known = StopWordsRemover.loadDefaultStopWords("english")
    assert set(S.ENGLISH) == {w for w in known if "'" not in w}


def test_token_budgets_cut_at_token_ends(spark):
    tokenizers = pytest.importorskip("tokenizers")

    def words():
        tokenizer = tokenizers.Tokenizer(tokenizers.models.WordLevel({"[UNK]": 0}, unk_token="[UNK]"))
        tokenizer.pre_tokenizer = tokenizers.pre_tokenizers.WhitespaceSplit()
        return tokenizer

    texts = ["  one  two three ", "é" * 50 + " b c d", "one", "", None, "x " * 200_000]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, article string")
    for most, summary in ((2, 5), (3, 1), (0, 4), (None, None)):
        method = S.model_method("echo", lambda: None, lambda m, a: [f"a b c {x}" for x in a], 2,
                                        tokenizer=words, max_input_tokens=most, max_summary_tokens=summary)
        got = {r["id"]: r["summary"].split() for r in S.summarize(df, method).collect()}
        for i, t in enumerate(texts):
            whole = (t or "").split()
            assert got[i] == (["a", "b", "c", *whole[:most]][:summary] if whole else [])
