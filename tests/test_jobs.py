"""Readers, writers, stream and the whole job."""

import json
import shutil
import warnings
from contextlib import nullcontext
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pithy.operators import quality
from pithy.plans.run_all import run_all
from pithy.session import BATCH_BYTES, BATCH_ROWS, checkpoint_root, job, spread, table_folder, table_name, written
from pithy.sources import readers, sinks
from pithy.sources.harmonise import SPECS, CorpusSpec, harmonise, read_with_row_keys, union_corpora
from pithy.streaming.digest import digest_pages, start_page_digest


@pytest.mark.parametrize(("suffix", "sep"), [("csv", ","), ("tsv", "\t")])
def test_delimited_text_keeps_quotes_and_line_breaks(spark, tmp_path, suffix, sep):
    file = tmp_path / f"data.{suffix}"
    file.write_text(sep.join(["id", "article", "highlights"]) + "\n"
                    + sep.join(["1", '"He said ""go"", then' + sep + '\nleft."', '"a"']) + "\n"
                    + sep.join(["2", "NA", "null"]) + "\n", encoding="utf-8")
    rows = readers.read_pairs(spark, str(file)).orderBy("id").collect()
    assert tuple(rows[0]) == ("1", f'He said "go", then{sep}\nleft.', "a")
    assert tuple(rows[1]) == ("2", None, None)


def test_parquet_and_jsonl(spark, tmp_path, corpus):
    corpus.write.parquet(str(tmp_path / "data.parquet"))
    assert sorted(readers.read_pairs(spark, str(tmp_path / "data.parquet")).collect()) == sorted(corpus.collect())
    file = tmp_path / "data.jsonl"
    file.write_text("\n".join(json.dumps({"id": i, "article": "x\ny", "highlights": None}) for i in (1, 2)))
    rows = readers.read_pairs(spark, str(file)).collect()
    assert [r["article"] for r in rows] == ["x\ny"] * 2 and rows[0]["highlights"] is None


def test_reader_errors(spark, tmp_path):
    with pytest.raises(quality.DataValidationError, match="nothing at"):
        readers.read_pairs(spark, str(tmp_path / "none.csv"))
    with pytest.raises(quality.DataValidationError, match="Cannot tell the format"):
        readers.read_pairs(spark, str(tmp_path / "data.xlsx"))


def test_articles_from_a_folder_and_row_cap(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.txt").write_text(f"Line one of {i}.\nLine two.")
    df = readers.read_articles(spark, str(tmp_path))
    assert sorted(r["article"][:13] for r in df.collect()) == [f"Line one of {i}." [:13] for i in range(3)]
    assert readers.limit_rows(df, 2).count() == 2 and readers.limit_rows(df, 0).count() == 3


def test_limit_without_a_single_partition(spark):
    df = spark.range(1000).repartition(13).withColumn("_place", F.lit("own"))
    for n in (1, 7, 76, 500, 999, 1000, 5000):
        got = readers.limit_rows(df, n)
        assert got.columns == df.columns and got.select("id").distinct().count() == got.count() == min(n, 1000)
        assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(got.collect()) == sorted(got.collect())
    assert readers.limit_rows(df.where("false"), 5).count() == 0


def test_row_keys_tell_identical_rows_apart(spark, tmp_path):
    rows = [("same text", "same summary")] * 30 + [("other", "x")] * 3
    df = spark.createDataFrame(rows, "article string, highlights string")
    df.repartition(4).write.parquet(str(tmp_path / "data"))
    keyed = read_with_row_keys(spark, str(tmp_path / "data"))
    ids = lambda d: sorted(r["id"] for r in harmonise(d, SPECS["cnn_dailymail"]).collect())
    first = ids(keyed)
    assert len(set(first)) == 33 and all(i.startswith("cnn_dailymail-") for i in first)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        assert ids(read_with_row_keys(spark, str(tmp_path / "data")).repartition(7)) == first
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ids(read_with_row_keys(spark, str(tmp_path / "data" / "*.parquet"))) == first
    shutil.copytree(tmp_path / "data", tmp_path / "elsewhere" / "data")
    assert ids(read_with_row_keys(spark, str(tmp_path / "elsewhere" / "data"))) == first


def test_harmonise(spark):
    a = spark.createDataFrame([("7", "text", None)], "id string, document string, summary string")
    b = spark.createDataFrame([("body", "sum"), (None, "s")], "article string, highlights string")
    df = union_corpora(harmonise(a, SPECS["xsum"]), harmonise(b, SPECS["cnn_dailymail"], "train"))
    assert df.columns == ["id", "source", "article", "highlights", "split"]
    rows = {r["article"]: r for r in df.collect()}
    assert tuple(rows["text"]) == ("7", "xsum", "text", "", "test")
    assert rows["body"]["split"] == "train" and len(rows["body"]["id"]) == 32 and rows[""]["highlights"] == "s"
    again = harmonise(b.repartition(5), CorpusSpec("cnn_dailymail", "article", "highlights"))
    assert {r["id"] for r in again.collect()} == {rows["body"]["id"], rows[""]["id"]}


def test_checkpoint_folder_is_the_sessions(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir", checkpoint_root(spark))


def test_spread_only_on_request(spark, tmp_path, corpus):
    corpus.coalesce(1).write.parquet(str(tmp_path / "one"))
    df = spark.read.parquet(str(tmp_path / "one"))
    before = spark.conf.get("pithy.partitions", None)
    try:
        spark.conf.set("pithy.partitions", 16)
        assert spread(df).rdd.getNumPartitions() == 16
        spark.conf.unset("pithy.partitions")
        assert "Exchange" not in spread(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        if before:
            spark.conf.set("pithy.partitions", before)


def test_missing_value_tokens(spark, tmp_path):
    file = tmp_path / "data.csv"
    file.write_text("article,highlights\n" + "".join(f"text,{m}\n" for m in readers.MISSING) + "text,-n/a\n")
    rows = readers.read_pairs(spark, str(file)).collect()
    assert [r["highlights"] for r in rows] == [None] * len(readers.MISSING) + ["-n/a"]


def test_jsonl_keeps_every_key_and_labels_bad_lines(spark, tmp_path):
    file = tmp_path / "data.jsonl"
    lines = [json.dumps({"document": f"One two three {i}. Four five.", "summary": "one", "lang": "en"}) for i in range(8)]
    file.write_text("\n".join([*lines, "not json"]))
    df = readers.read_pairs(spark, str(file), label_corrupt=True)
    assert set(df.columns) == {"document", "summary", "lang", "_corrupt_record"}
    assert "_corrupt_record" not in readers.read_pairs(spark, str(file)).columns
    paths = run_all(spark, str(file), str(tmp_path / "out"), ["lead_3"], cols=quality.Columns("document", "summary", None, None),
                    variants=("rouge1",), on_bad_rows="quarantine")
    assert [r[0] for r in spark.read.parquet(paths["rejected"]).select("reject_reason").collect()] == ["corrupt_record"]
    assert spark.read.parquet(paths["prepared"]).count() == 8


def test_jsonl_texts_are_read_once(spark, tmp_path):
    """Reading by keys that differ from line to line: one scan of the file; the table scan for keys reads no values."""
    lines = [{"a": i, "b": "x\ny", "only": None} if i % 2 else {"b": 1.5, "deep": {"k": [1, "z"]}, "a b.c": True} for i in range(40)]
    (tmp_path / "d.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n\n[1]\n{\"b\": \n")
    df = readers.read_pairs(spark, str(tmp_path / "d.jsonl"), label_corrupt=True)
    assert df.columns == ["a", "a b.c", "b", "deep", "only", "_corrupt_record"]
    rows = df.collect()
    assert sorted(r["_corrupt_record"] for r in rows if r["_corrupt_record"]) == ["[1]", '{"b": ']
    assert sorted((r["a"] or "", r["a b.c"] or "", r["b"] or "", r["deep"] or "") for r in rows if not r["_corrupt_record"]) == sorted(
        (str(x["a"]), "", "x\ny", "") if "a" in x else ("", "true", "1.5", '{"k":[1,"z"]}') for x in lines)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "d.jsonl" not in plan and plan.count("FileScan") == 1
    assert readers.read_pairs(spark, str(tmp_path / "d.jsonl")).columns == ["a", "a b.c", "b", "deep", "only"]


def test_csv_lines_of_another_width_are_labelled(spark, tmp_path):
    file = tmp_path / "data.csv"
    file.write_text("article,highlights\na b,c\na b,c,d,e\n")
    rows = readers.read_pairs(spark, str(file), label_corrupt=True).collect()
    assert [r["_corrupt_record"] is None for r in rows] == [True, False]


def test_run_all_scores_every_test_row(spark, tmp_path):
    rows = [(i, "s", f"First sentence of text {i}. Second one here. Third one too.", f"First sentence {i}") for i in range(800)]
    spark.createDataFrame(rows, "id long, source string, article string, highlights string").write.parquet(str(tmp_path / "in.parquet"))
    paths = run_all(spark, str(tmp_path / "in.parquet"), str(tmp_path / "out"), variants=("rouge1",))
    assert sinks.read_rows(spark, paths["qualitative_review"]).count() == 400
    assert spark.read.json(paths["paired_lead_3_textrank"]).first()["ties"] >= 0
    assert [r[0] for r in spark.read.json(paths["sources"]).collect()] == ["s"]


PAGE = "<title>T{0}</title><article><p>{1}</p></article>"


def page_rows(ids):
    body = " ".join(f"Sentence number {i} has exactly seven words." for i in range(6))
    return [(i, f"http://h{i}.example.com/x", PAGE.format(i, body if i % 4 else "short")) for i in ids]


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    schema, src, out = "page_id long, url string, html string", str(tmp_path / "in"), str(tmp_path / "out")
    for ids in (range(10), range(10, 17)):
        spark.createDataFrame(page_rows(ids), schema).repartition(3).write.mode("append").parquet(src)
        start_page_digest(
            spark, src, out, method="textrank", max_files_per_trigger=2,
            checkpoint_dir=str(tmp_path / "progress"),
        ).awaitTermination()
    batch = digest_pages(spark.read.parquet(src), "textrank")
    streamed = spark.read.parquet(out)
    assert sorted(streamed.collect()) == sorted(batch.select(*streamed.columns).collect())
    assert streamed.count() == 17
    assert {r["page_id"] for r in streamed.where("summary = ''").collect()} == {i for i in range(17) if not i % 4}


def test_run_all(spark, tmp_path, corpus):
    corpus.write.parquet(str(tmp_path / "in.parquet"))
    paths = run_all(spark, str(tmp_path / "in.parquet"), str(tmp_path / "out"), n=2)
    rows = sinks.read_rows(spark, paths["qualitative_review"])
    assert rows.count() == 4 and {r["method"] for r in rows.collect()} == {"lead_3", "textrank"}
    summary = spark.read.csv(paths["method_summary"], header=True).collect()
    assert {r["method"] for r in summary} == {"lead_3", "textrank"} and summary[0].asDict().keys() == {
        "method", "n_examples", "rouge1", "rouge2", "rougeL", "rougeLsum",
        "mean_summary_length", "mean_compression_ratio", "mean_inference_seconds",
    }
    metrics = sinks.read_metrics(spark, paths["rouge_metrics"]).collect()
    assert all(0 <= r["rouge1"] <= 1 and r["mean_inference_seconds"] > 0 for r in metrics)
    assert spark.read.json(paths["article_length"]).count() == 20
    prepared = spark.read.parquet(paths["prepared"])
    assert {r["split"]: r["count"] for r in prepared.groupBy("split").count().collect()} == {"test": 2, "train": 6}


def test_a_killed_run_leaves_the_results_before_it(spark, tmp_path, corpus, monkeypatch):
    from pithy.plans import run_all as job
    corpus.write.parquet(str(tmp_path / "in.parquet"))
    out = str(tmp_path / "out")
    assert sinks.current_run(spark, out) is None
    options = {"methods": ["lead_3"], "variants": ("rouge1",)}
    first = run_all(spark, str(tmp_path / "in.parquet"), out, **options)
    assert first["method_summary"].startswith(sinks.current_run(spark, out))
    before = sorted(sinks.read_rows(spark, first["qualitative_review"]).collect())

    def killed(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(job, "write_metrics", killed)
        with pytest.raises(KeyboardInterrupt):
            run_all(spark, str(tmp_path / "in.parquet"), out, n=1, **options)
    now = sinks.current_run(spark, out)
    assert first["method_summary"].startswith(now) and sorted(sinks.read_rows(spark, f"{now}/qualitative_review").collect()) == before
    again = run_all(spark, str(tmp_path / "in.parquet"), out, n=1, **options)
    assert again["method_summary"].startswith(sinks.current_run(spark, out)) and again != first


def test_a_job_removes_its_intermediate_tables(spark):
    root = checkpoint_root(spark)
    left, rows = written(spark.range(3), "outside"), spark.conf.get(BATCH_ROWS)
    for fails in (False, True):
        with pytest.raises(ZeroDivisionError) if fails else nullcontext(), job(spark):
            folder = table_folder(spark)
            assert folder != root and written(spark.range(5), "inside").count() == 5
            with job(spark):
                spark.conf.set(BATCH_ROWS, 7)
                assert table_folder(spark) == folder
            assert Path(folder.removeprefix("file:")).exists()
            name = table_name(spark)
            spark.range(2).write.option("path", f"{folder}/{name}").saveAsTable(name)
            if fails:
                1 / 0
        assert not Path(folder.removeprefix("file:")).exists() and table_folder(spark) == root and not spark.catalog.tableExists(name)
        assert spark.conf.get(BATCH_ROWS) == rows
    assert left.count() == 3


def test_run_all_cleans_in_small_batches(spark, tmp_path, corpus, monkeypatch):
    corpus.write.parquet(str(tmp_path / "in.parquet"))
    prepare, seen = quality.prepare, []
    monkeypatch.setattr(quality, "prepare", lambda *args: seen.append([int(spark.conf.get(BATCH_ROWS)), spark.conf.get(BATCH_BYTES)]) or prepare(*args))
    with job(spark):
        spark.conf.set(BATCH_ROWS, 10_000)
        spark.conf.set(BATCH_BYTES, "64m")
        run_all(spark, str(tmp_path / "in.parquet"), str(tmp_path / "out"), variants=("rouge1",))
    assert seen == [[1000, str(8 << 20)]]


def test_run_all_leaves_no_intermediate_tables(spark, tmp_path, corpus):
    corpus.write.parquet(str(tmp_path / "in.parquet"))
    written(corpus, "before")
    before = sorted(p.name for p in Path(checkpoint_root(spark).removeprefix("file:")).iterdir())
    run_all(spark, str(tmp_path / "in.parquet"), str(tmp_path / "out"), ["lead_3"], variants=("rouge1",))
    assert sorted(p.name for p in Path(checkpoint_root(spark).removeprefix("file:")).iterdir()) == before


def test_run_all_quarantines_or_raises(spark, tmp_path, corpus):
    bad = corpus.union(spark.createDataFrame([(99, "wire", " ", "x")], corpus.schema)).drop("id")
    bad.write.json(str(tmp_path / "in.jsonl"))
    with pytest.raises(quality.DataValidationError, match="article column article"):
        run_all(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "a"))
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        paths = run_all(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "b"), ["lead_3"],
                        variants=("rouge1",), max_examples=None, on_bad_rows="quarantine")
    assert spark.read.parquet(paths["rejected"]).select("reject_reason").first()[0] == "empty_article"
    assert spark.read.parquet(paths["prepared"]).count() == 8


def test_results_as_csv_read_back(spark, tmp_path, corpus):
    from pithy.operators import evaluate as ev
    scores = ev.score_methods(corpus.withColumn("article", F.concat(F.lit('A "quoted"\nline. '), "article")), ["lead_3"])
    sinks.write_rows(scores, str(tmp_path / "rows"), "csv")
    back = sinks.read_rows(spark, str(tmp_path / "rows"), "csv")
    assert sorted((r["article"], r["rouge1_f1"]) for r in back.collect()) == sorted(
        (r["article"], r["rouge1_f1"]) for r in scores.collect())
