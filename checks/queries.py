"""One query per operator, over whole test tables.

The tables hold no ready article-summary pairs. Pairs come from `documents`: the
first sentence is held out as the reference, the rest is the article; and from
`pages`: the title is the reference, the body the article.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pithy.functions import text
from pithy.functions.arrays import compute_once
from pithy.operators import dedup, pages, quality, reports, split, summarize, tfidf
from pithy.operators import evaluate as ev
from pithy.plans.run_all import run_all
from pithy.session import checkpoint_root, spread, written
from pithy.sources import readers, sinks
from pithy.sources.harmonise import CorpusSpec, harmonise, read_with_row_keys, union_corpora
from pithy.streaming.digest import digest_pages, start_page_digest

EXACT = {"stem": False}  # what SQL can check; the default scoring stems


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf}/{name}.parquet"))


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """(id, source, article) with the text cleaned."""
    docs = table(spark, sf, "documents")
    return docs.select(
        F.col("doc_id").alias("id"), "source", text.normalize_article(F.col("text")).alias("article")
    )


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return compute_once(docs, {"sentences": text.split_sentences(F.col("article"))})


def raw_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """(id, source, article, highlights), bad rows included."""
    s = F.col("sentences")
    rest = F.slice(s, F.lit(2), F.greatest(F.size(s) - 1, F.lit(0)))
    return compute_once(sentences(spark, sf).drop("article"), {
        "article": text.join_sentences(rest),
        "highlights": F.coalesce(F.get(s, F.lit(0)), F.lit("")),
    }).drop("sentences")


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = quality.quarantine(raw_pairs(spark, sf))
    return good


def scores(spark: SparkSession, sf: str, variants=("rouge1",)) -> DataFrame:
    return ev.score_methods(pairs(spark, sf), variants=variants, **EXACT)


def weights(spark: SparkSession, sf: str, packed: bool = False) -> DataFrame:
    return tfidf.sentence_weights(sentences(spark, sf), packed=packed)


# --- text ---

def normalize_text(spark, sf):
    return documents(spark, sf).select("id", "article")


def page_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.strip_html(F.col("html")).alias("text"))


def clean_cells(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", text.clean_cell(F.col("text")).alias("text")
    )


def split_sentences(spark, sf):
    return sentences(spark, sf).select("id", F.posexplode("sentences").alias("si", "sentence"))


def word_counts(spark, sf):
    return sentences(spark, sf).select(
        "id", text.word_count(F.col("article")).alias("words"), F.size("sentences").alias("n_sentences"),
        summarize.short_input(F.col("sentences")).alias("short_input"),
    )


def effective_n(spark, sf):
    total = F.size("sentences")
    return sentences(spark, sf).select(
        "id", total.alias("total"),
        *[summarize.effective_n(n, total).alias(f"n{n}") for n in (0, 1, 3, 5, 10)],
    )


# --- quality ---

def validation_profile(spark, sf):
    row = quality.profile(raw_pairs(spark, sf))
    parts = [
        F.col(f"{side}_lengths.{stat}").cast("double").alias(f"{side}_{stat}")
        for side in ("article", "summary") for stat in ("mean", "median", "min", "max")
    ]
    flat = row.select(
        "rows", F.array_join("columns", ",").alias("columns"), "sources", "duplicate_rows",
        "empty_article_rows", "empty_summary_rows", "summary_longer_than_article_rows", *parts,
    )
    return rounded(flat, "article_mean", "summary_mean")


def row_quarantine(spark, sf):
    return quality.add_checks(raw_pairs(spark, sf)).select(
        "id", "article_words", "summary_words", "reject_reason"
    )


def valid_rows(spark, sf):
    return pairs(spark, sf).select("id", "highlights")


def first_offenders(spark, sf):
    return quality.offenders(raw_pairs(spark, sf), "empty_article")


def duplicate_count(spark, sf):
    return quality.duplicate_count(raw_pairs(spark, sf))


def snapshot_counts(spark, sf):
    return quality.snapshot_counts(raw_pairs(spark, sf))


def distinct_sources(spark, sf):
    return quality.distinct_sources(table(spark, sf, "documents"))


def prepared_pairs(spark, sf):
    """Page markup as the article, title as the summary: both cleaned."""
    df = table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), F.col("html").alias("article"), F.col("url").alias("highlights")
    )
    return quality.prepare(df)


def dedup_first(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("article"))
    return dedup.deduplicate(docs).select("id", F.length("article").alias("chars"))


# --- splits ---

def hash_split(spark, sf):
    return split.random_split(documents(spark, sf)).select("id", "split")


def bucket_split(spark, sf):
    return split.bucket_split(documents(spark, sf)).select("id", "split")


def labelled_documents(spark, sf, label: Column) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "source")
    labels = spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("doc_id", "id")
    return reports.with_metadata(docs, labels).withColumn("split", label)


def explicit_split(spark, sf):
    label = (
        F.when(F.col("toxic") == 1, "other").when(F.col("quality") == 0, " Dev ")
        .when(F.col("quality") == 1, "TEST").otherwise("train")
    )
    return split.split_dataset(labelled_documents(spark, sf, label)).select("id", "split")


def split_fallback(spark, sf):
    """One label for all rows, as a fetched corpus has it: split by hash instead."""
    return split.split_dataset(labelled_documents(spark, sf, F.lit("test"))).select("id", "split")


def split_skew(spark, sf):
    df = reports.split_skew(split.random_split(pairs(spark, sf)))
    return rounded(df, "mean_article_words", "mean_summary_words", "mean_reference_compression")


def capped_rows(spark, sf):
    return split.cap_rows(raw_pairs(spark, sf), 50).select("id", "highlights")


# --- summaries ---

def lead_n(spark, sf):
    return summarize.summarize(documents(spark, sf), "lead_3").select(
        "id", "method", "summary", "short_input"
    )


def tfidf_weights(spark, sf):
    return rounded(weights(spark, sf), "weight").select("id", "si", "token", "tf", "df", "weight")


def sentence_strength(spark, sf):
    return rounded(tfidf.sentence_strength(weights(spark, sf, packed=True)), "strength")


def lead_similarity(spark, sf):
    return rounded(tfidf.similarity_to(weights(spark, sf, packed=True), 0), "similarity")


def pagerank_scores(spark, sf):
    df = sentences(spark, sf).select("id", summarize.sentence_scores(F.col("sentences")).alias("s"))
    return rounded(df.select("id", F.posexplode("s").alias("si", "score")), "score")


def textrank_summary(spark, sf):
    return summarize.summarize(documents(spark, sf), "textrank").select("id", "method", "summary")


def all_methods(spark, sf):
    """Every article with every method in one pass."""
    df = summarize.add_summaries(documents(spark, sf))
    return df.select("id", "summary_lead_3", "summary_textrank")


def model_hook_stub(spark, sf):
    """A stand-in model, so that the hook is exercised: the longest sentence wins."""
    def load():
        return lambda article: max(article.split(". "), key=len)

    def predict(model, articles):
        return [model(a) for a in articles]

    method = summarize.model_method("longest", load, predict)
    return summarize.summarize(documents(spark, sf), method).select("id", "method", "summary")


def model_token_budget(spark, sf):
    """A stub model that repeats its input and counts its words, under budgets of 40 and 12 tokens."""
    def words():
        from tokenizers import Tokenizer, models, pre_tokenizers

        tokenizer = Tokenizer(models.WordLevel({"[UNK]": 0}, unk_token="[UNK]"))
        tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        return tokenizer

    def predict(model, articles):
        return [f"{len(a.split())} {a}" for a in articles]

    method = summarize.model_method("stub", lambda: None, predict, tokenizer=words, max_input_tokens=40, max_summary_tokens=12)
    return summarize.summarize(documents(spark, sf), method).select("id", "method", "summary")


# --- scores ---

def _rouge(variant: str, stem: bool = False) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        df = ev.score_methods(pairs(spark, sf), variants=(variant,), stem=stem)
        parts = ["f1", "precision", "recall"]
        return rounded(
            df.select("id", "method", *[F.col(f"{variant}_{p}").alias(p) for p in parts]), *parts
        )

    return query


def qualitative_rows(spark, sf):
    df = scores(spark, sf)
    return rounded(df.select(
        "id", "source", "method", "reference_summary", "generated_summary", "summary_length",
        F.coalesce(ev.compression(), F.lit(0.0)).alias("compression"), "rouge1_f1",
    ), "compression", "rouge1_f1")


def method_summary(spark, sf):
    df = ev.method_summary(scores(spark, sf, ev.ALL_VARIANTS))
    return rounded(
        df.drop("mean_inference_seconds"), *ev.ALL_VARIANTS, "mean_summary_length", "mean_compression_ratio"
    )


def blank_rows_summary(spark, sf):
    """Nothing set aside: blank articles score 0 and count everywhere but in compression."""
    scored = ev.score_methods(raw_pairs(spark, sf), variants=("rouge1",), **EXACT)
    df = ev.method_summary(scored, ("rouge1",)).drop("mean_inference_seconds")
    return rounded(df, "rouge1", "mean_summary_length", "mean_compression_ratio")


def rounded_report(spark, sf):
    return ev.rounded_summary(ev.method_summary(scores(spark, sf), ("rouge1",))).drop("mean_inference_seconds")


def method_summary_stemmed(spark, sf):
    df = ev.method_summary(ev.score_methods(pairs(spark, sf))).drop("mean_inference_seconds")
    return rounded(df, *ev.ALL_VARIANTS, "mean_summary_length", "mean_compression_ratio")


def precision_recall(spark, sf):
    variants = ("rouge1", "rouge2")
    df = ev.precision_recall(scores(spark, sf, variants), variants)
    return rounded(df, *[c for c in df.columns if c != "method"])


# --- reports ---

def length_describe(spark, sf):
    df = reports.describe_lengths(pairs(spark, sf))
    return rounded(df, *[c for c in df.columns if c not in ("statistic", "count")])


def score_distribution(spark, sf):
    variants = ("rouge1", "rouge2")
    df = reports.score_distribution(scores(spark, sf, variants), variants)
    return rounded(df, *[c for c in df.columns if c not in ("method", "variant", "count")])


def method_paired(spark, sf):
    return reports.paired_comparison(scores(spark, sf), "textrank", "lead_3")


def best_worst(spark, sf):
    return reports.best_and_worst(scores(spark, sf))


def length_histogram(spark, sf):
    df = reports.length_histogram(pairs(spark, sf), "article")
    return rounded(df, "from_words", "to_words")


def rouge_pivot(spark, sf):
    variants = ("rouge1", "rouge2")
    return rounded(reports.rouge_pivot(scores(spark, sf, variants), variants), *variants)


def rouge_matrix(spark, sf):
    variants = ("rouge1", "rouge2")
    return rounded(
        reports.rouge_matrix(ev.method_summary(scores(spark, sf, variants), variants), variants), "f1"
    )


def score_curve(spark, sf):
    return reports.score_curve(scores(spark, sf))


def quality_by_source(spark, sf):
    df = reports.quality_by_characteristic(scores(spark, sf))
    return rounded(df, "mean_rouge1_f1", "mean_compression_ratio")


def quality_by_label(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("doc_id", "id")
    df = reports.quality_by_characteristic(
        reports.with_metadata(scores(spark, sf), labels), ("quality", "toxic")
    )
    return rounded(df, "mean_rouge1_f1", "mean_compression_ratio")


def compression_by_method(spark, sf):
    df = reports.compression_by_method(ev.method_summary(scores(spark, sf), ("rouge1",)))
    return rounded(df, "mean_compression_ratio", "mean_summary_length")


# --- sources, sinks and checks ---

def _folder(spark, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}_{uuid.uuid4().hex}"


def csv_records(spark, sf):
    """Documents as CSV, line breaks and quotes in their texts, read back in many tasks."""
    path = _folder(spark, "csv_records")
    docs = table(spark, sf, "documents")
    sinks.write_rows(docs.select(F.col("doc_id").alias("id"), "source", F.col("text").alias("article"), F.col("lang").alias("highlights")), path, "csv")
    back = readers.read_pairs(spark, path, "csv")
    return back.select("id", "source", F.md5("article").alias("article"), "highlights")


def tsv_records(spark, sf):
    """Conversations as tab-separated text, tabs put into theirs."""
    path = _folder(spark, "tsv_records")
    turns = table(spark, sf, "conversations").withColumn("text", F.concat("text", F.lit('\t"\n'), "role"))
    turns.write.options(header=True, sep="\t", quote='"', escape='"').csv(path)
    return readers.read_pairs(spark, path, "tsv").select("conv_id", "turn", "role", F.md5("text").alias("text"))


def jsonl_records(spark, sf):
    """Pages as JSON lines, one key of them only where the id is even."""
    path = _folder(spark, "jsonl_records")
    even = F.when(F.col("page_id") % 2 == 0, F.col("url"))
    table(spark, sf, "pages").select("page_id", even.alias("even_url"), "html").write.json(path)
    return readers.read_pairs(spark, path, "jsonl").select("page_id", "even_url", F.md5("html").alias("html"))


def limited_rows(spark, sf):
    """How many rows a limit leaves, and how many of them are rows of the table."""
    docs = table(spark, sf, "documents").select("doc_id")
    few, many = (readers.limit_rows(docs, n).join(docs, "doc_id", "left_semi") for n in (77, 10**9))
    count = lambda df, name: df.agg(F.count("*").alias("rows"), F.countDistinct("doc_id").alias("ids")).select(F.lit(name).alias("limit"), "*")
    return count(few, "77").unionByName(count(many, "all"))


def row_keys(spark, sf):
    """Documents without their id, the text cut to one word: identical rows still have ids of their own."""
    docs = read_with_row_keys(spark, f"{sf}/documents.parquet").select("row_key", F.substring_index("text", " ", 1).alias("text"), "lang")
    keyed = harmonise(docs, CorpusSpec("documents", "text", "lang"))
    return keyed.groupBy("article", "highlights").agg(F.count("*").alias("rows"), F.countDistinct("id").alias("ids"))


def written_scores(spark, sf):
    """Scored rows through their sink and back, as CSV."""
    path = _folder(spark, "written_scores")
    sinks.write_rows(scores(spark, sf), path, "csv")
    return rounded(sinks.read_rows(spark, path, "csv").select(
        F.col("id").cast("long").alias("id"), "method", "generated_summary", "summary_length", "rouge1_f1"), "rouge1_f1")


def written_metrics(spark, sf):
    """Metrics through their sink and back."""
    path = _folder(spark, "written_metrics")
    sinks.write_metrics(ev.method_summary(scores(spark, sf), ("rouge1",)), path)
    df = sinks.read_metrics(spark, path).drop("mean_inference_seconds")
    return rounded(df, "rouge1", "mean_summary_length", "mean_compression_ratio")


def timed_scores(spark, sf):
    """How many rows the scoring run timed, none at zero, and whether it took hours for one."""
    timed = ev.score_methods(pairs(spark, sf), variants=("rouge1",), timed=True, **EXACT)
    return timed.groupBy("method").agg(
        F.count("*").alias("rows"), F.count_if(F.col("elapsed_seconds") > 0).alias("timed"),
        F.count_if(F.col("elapsed_seconds") > 3600).alias("too_long"),
    )


def failed_checks(spark, sf):
    """Which check stops a table first: columns, no rows, articles, summaries, swapped columns - in this order."""
    raw = written(pairs(spark, sf), "fine-pairs")
    blank = lambda df, c: df.withColumn(c, F.when(F.col("id") % 3 == 0, F.lit(" ")).otherwise(F.col(c)))
    swapped = raw.select("id", "source", F.col("highlights").alias("article"), F.col("article").alias("highlights"))
    cases = {
        "fine": raw, "no column": raw.drop("highlights"), "no rows": raw.where("false"), "no articles": blank(raw, "article"),
        "no summaries": blank(raw, "highlights"), "both": blank(blank(raw, "highlights"), "article"), "swapped": swapped,
        "swapped and blank": blank(swapped, "highlights"),
    }
    signs = {"No column": "columns", "no rows": "rows", "article column": "articles", "summary column": "summaries", "swapped": "order"}
    found = []
    for name, df in cases.items():
        status = "passed"
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore", UserWarning)
                quality.validate(df)
        except quality.DataValidationError as error:
            status = next(s for sign, s in signs.items() if sign in str(error))
        found.append((name, status))
    return spark.createDataFrame(found, "table string, stopped_by string")


def run_all_tables(spark, sf):
    """Rows of the tables that the whole job leaves in its folder."""
    folder = _folder(spark, "run_all")
    raw_pairs(spark, sf).write.parquet(f"{folder}/in")
    run_all(spark, f"{folder}/in", f"{folder}/out", variants=("rouge1",), fmt="parquet", on_bad_rows="quarantine")
    run = sinks.current_run(spark, f"{folder}/out")
    count = lambda df, name: df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("result"), "rows")
    prepared = spark.read.parquet(f"{run}/prepared")
    tables = {
        "prepared test": prepared.where("split = 'test'"), "prepared train": prepared.where("split = 'train'"),
        "rejected": spark.read.parquet(f"{run}/rejected"), "scores": sinks.read_rows(spark, f"{run}/qualitative_review"),
        "metrics": sinks.read_metrics(spark, f"{run}/rouge_metrics"), "summary": spark.read.csv(f"{run}/method_summary", header=True),
        "sources": spark.read.json(f"{run}/reports/sources"),
    }
    return reduce(DataFrame.unionByName, [count(df, name) for name, df in tables.items()])


# --- corpora and pages ---

def harmonised_union(spark, sf):
    docs = harmonise(
        table(spark, sf, "documents").withColumnRenamed("doc_id", "id"),
        CorpusSpec("documents", "text", "lang"),
    )
    items = harmonise(table(spark, sf, "benchmark"), CorpusSpec("benchmark", "text", "summary"), "train")
    turns = harmonise(table(spark, sf, "conversations"), CorpusSpec("conversations", "text", "role"))
    return union_corpora(docs, items, turns).withColumn("article", F.md5("article"))


def page_articles(spark, sf):
    return pages.parse_pages(table(spark, sf, "pages"))


def nested_articles(spark, sf):
    """Pages whose article holds another one, and side elements that hold more of their own kind."""
    remark = F.concat(F.lit("<p>A nested remark of more than eight words in all, on page "), F.col("page_id"), F.lit("</p>"))
    side = "".join(f"<{e}><div><{e}>x</{e}></div>{{}}</{e}>" for e in ("aside", "nav", "header", "form")).replace("{}", "<p>" + "leaked " * 9 + "</p>")
    inside = F.concat(F.lit(f"<article>{side}<section><article>"), remark, F.lit(f"</article></section>{side}"))
    df = table(spark, sf, "pages")
    return pages.parse_pages(df.withColumn("html", F.replace("html", F.lit("<article>"), inside)))


def old_entities(spark, sf):
    """Titles between entities that end without a semicolon."""
    title = F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1))
    df = table(spark, sf, "pages").select("page_id", F.concat(
        F.lit("<p>caf&eacute <b>&copy 2030</b> AT&T &amp;uml &#233 &ampx &notit; "), title, F.lit(" R&D&frac12&Uuml</p>")).alias("html"))
    return df.select("page_id", text.strip_html(F.col("html")).alias("text"))


def page_domain(spark, sf):
    df = table(spark, sf, "pages").select(text.domain(F.col("url")).alias("domain"))
    return df.groupBy("domain").agg(F.count("*").alias("pages"))


def page_pairs_scored(spark, sf):
    """Titles as references of page bodies, scored without cutting anything."""
    parsed = pages.parse_pages(table(spark, sf, "pages")).where("status = 'ok'")
    df = ev.score_methods(
        parsed.select(F.col("page_id").alias("id"), "article", F.col("title").alias("highlights")),
        ["lead_3"], variants=("rouge1",), **EXACT,
    )
    return rounded(df.select("id", "summary_length", "rouge1_f1"), "rouge1_f1")


def page_digest(spark, sf):
    return digest_pages(table(spark, sf, "pages"))


def stream_digest(spark, sf):
    """The same digest, run as a stream over the page files."""
    run = f"page_digest_{uuid.uuid4().hex}"
    out = f"{checkpoint_root(spark)}/{run}_out"
    start_page_digest(spark, f"{sf}/pages*.parquet", out, run).awaitTermination()
    return spark.read.parquet(out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        normalize_text, page_text, clean_cells, split_sentences, word_counts, effective_n,
        validation_profile, row_quarantine, valid_rows, first_offenders, duplicate_count,
        snapshot_counts, distinct_sources, prepared_pairs, dedup_first,
        hash_split, bucket_split, explicit_split, split_fallback, split_skew, capped_rows,
        lead_n, tfidf_weights, sentence_strength, lead_similarity, pagerank_scores,
        textrank_summary, all_methods, model_hook_stub, model_token_budget,
        qualitative_rows, method_summary, blank_rows_summary, rounded_report, method_summary_stemmed, precision_recall,
        length_describe, score_distribution, method_paired, best_worst, length_histogram,
        rouge_pivot, rouge_matrix, score_curve, quality_by_source, quality_by_label,
        compression_by_method,
        csv_records, tsv_records, jsonl_records, limited_rows, row_keys, written_scores, written_metrics, timed_scores, failed_checks, run_all_tables,
        harmonised_union, page_articles, nested_articles, old_entities, page_domain, page_pairs_scored, page_digest, stream_digest,
    )
} | {
    "rouge1": _rouge("rouge1"), "rouge2": _rouge("rouge2"), "rouge_l": _rouge("rougeL"),
    "rouge_lsum": _rouge("rougeLsum"), "rouge1_stemmed": _rouge("rouge1", stem=True),
    "rouge2_stemmed": _rouge("rouge2", stem=True), "rouge_l_stemmed": _rouge("rougeL", stem=True),
}
