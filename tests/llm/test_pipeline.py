"""The pipeline's stages against what each should do, and all ten queries on the small tables."""

import random

import corpus_pipeline
import pytest
from pithy.llm import decontam
from pithy.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    random.seed(11)
    def words(n):
        return " ".join("".join(random.choices("abcdefghijklmnoprstu", k=random.randint(2, 8))) for _ in range(n))

    item = words(30)
    rows = [(i, words(random.randint(30, 80)), "en", f"s{i % 4}", 0) for i in range(40)]
    rows += [(100, rows[3][1], "en", "s", 0), (101, rows[3][1].upper(), "en", "s", 0), (102, f"{words(5)} {item} {words(5)}", "en", "s", 0),
             (103, f"{words(40)} token=k9Xw2LmQ8vRt5ZpB {words(3)}", "en", "s", 0), (104, None, "en", "s", 0), (105, "12 !!", None, None, None),
             (None, words(30), "en", "s", 0), (7, words(33), "en", "s", 0), (7, rows[7][1], "en", "s", 0)]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_stages(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.language(spark, docs, folder)
    texts = sorted(r.text for r in kept.collect())
    assert texts == sorted(t for _, t, *_ in rows if t and any(c.isalpha() for c in t)) and kept.columns == docs.columns

    once = corpus_pipeline.near_duplicates(spark, kept, folder)
    assert once.count() == len({t.lower() for t in texts})  # copies differ in case at most
    ids = [r.doc_id for r in once.collect()]
    assert 100 not in ids and 101 not in ids and 3 in ids and None in ids and ids.count(7) == 2

    clean = corpus_pipeline.decontamination(spark, once, folder)
    bad = {r.doc_id for r in decontam.contaminated(once, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
    assert bad == {102} and sorted(map(str, (r.doc_id for r in clean.collect()))) == sorted(str(i) for i in ids if i != 102)

    redacted = corpus_pipeline.secrets(spark, clean, folder)
    assert redacted.columns == docs.columns and redacted.count() == clean.count()
    assert "token=[SECRET]" in next(r.text for r in redacted.collect() if r.doc_id == 103)

    pieces = corpus_pipeline.packing(spark, redacted, folder)
    assert pieces.select("doc_id").distinct().count() == redacted.select("doc_id").distinct().count()


def test_stages_keep_columns_of_any_name(spark, corpus):
    """Columns that have the names of the stages' own."""
    folder, rows = corpus
    names = ["_id", "_seen", "score", "lang_pred", "_doc", "_tkey", "_cuts", "fingerprint", "component_id", "key", "row", "words", "n", "d"]
    long_ = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
    docs = spark.createDataFrame([(*r, *[f"{n}{i}" for n in names]) for i, r in enumerate([*rows, (500, long_, "en", "s", 1), (501, "", None, None, 0)])],
                                 f"{SCHEMA}, {', '.join(f'{n} string' for n in names)}")
    before = {r["_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, folder)
        assert found.columns == docs.columns, name
        for r in found.collect():
            was = before[r["_id"]]
            assert tuple(r[n] for n in names) == tuple(was[n] for n in names), name
            assert r.text == was.text or "[SECRET]" in r.text and name == "secrets"
        docs = found
    assert corpus_pipeline.packing(spark, docs, folder).where("doc_id = 500").agg({"length": "sum"}).first()[0] > 60_000


def test_run_applies_all_stages(spark, corpus):
    folder, _ = corpus
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None
    out = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 30


def test_stages_of_empty_tables(spark, corpus):
    folder, _ = corpus
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_a_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op4_html_extraction", "op6_embedding_near_dedup", "op9_chat_formatting", "op2_secret_scans"])
def test_queries_return_a_row_per_input_row(spark, name):
    table = {"op4": "pages", "op6": "embeddings", "op2": "documents"}.get(name[:3])
    rows = QUERIES[name](spark, SMALL).count()
    if table:
        assert rows == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    else:
        assert rows == spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id").distinct().count() + 1
