"""From raw documents to packed training sequences: five stages, each one operator.

Every stage's result is written to the shared folder and read again as the next
one's documents. All stages but the last keep the columns of `documents`, and any
others, whatever their names. Rows with a null id, and rows of different text that
share an id, work under a hash of both, so they never remove each other. Every stage
takes whole texts, long or empty, and an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pithy.llm.common import free_name
from pithy.llm.decontam import contaminated
from pithy.llm.langid import UNDETERMINED, fit, predict
from pithy.llm.packing import pack
from pithy.llm.secrets import redact_live
from pithy.llm.simhash import simhash_components
from pithy.session import written

LEAST_LANGUAGE_SCORE = 0.1
#: Of the SimHash operator's contract: words of a shingle, differing bits that still link.
SHINGLE, RADIUS = 4, 4


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a key in a new column, and its name: the document's id, or a hash of id and text where the id is null or repeated."""
    key, seen = free_name(docs, "_id"), free_name(docs, "_seen")
    repeated = docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select(F.col("doc_id").alias(seen))
    own = F.xxhash64(F.col("doc_id"), F.coalesce("text", F.lit("")))
    marked = docs.join(written(repeated, "repeated-ids"), F.col("doc_id") == F.col(seen), "left")
    return marked.withColumn(key, F.when(F.col("doc_id").isNull() | F.col(seen).isNotNull(), own).otherwise(F.col("doc_id"))).drop(seen), key


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters (null and empty texts too) or whose n-grams no learned language knows.

    Learns from all rows with a label; nothing is rejected where nothing was learned.
    """
    model = fit(docs.where("doc_id is not null and lang is not null"))
    if not model.languages:
        return docs
    name, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    found = predict(docs, model, lang_col=name, score_col=score)
    return found.where((F.col(name) != UNDETERMINED) & (F.col(score) >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component: the one with the least id, once.

    Documents link where their SimHashes of four-word shingles differ in at most four
    bits; null and blank texts are one component. The few that go are joined to the
    documents, not the many that stay. Of repeated rows one stays.
    """
    rows, key = keyed(docs)
    found = written(simhash_components(rows, key, shingle=SHINGLE, radius=RADIUS), "components")
    own = F.col(key) == F.col("component_id")
    gone = written(found.where(~own).select(key).distinct(), "duplicates")
    repeated = written(found.where(own).groupBy(key).count().where("count > 1").select(key), "repeated")
    once = rows.join(written(gone.unionByName(repeated), "not-once"), key, "left_anti")
    again = rows.join(repeated, key, "left_semi").dropDuplicates([key])
    return once.unionByName(again).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item; null and empty texts hold none."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, key = keyed(docs)
    bad = written(contaminated(rows, benchmark, key).select(key).distinct(), "contaminated")
    return rows.join(bad, key, "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces live credentials in the texts and counts their characters anew; no document goes, null texts stay null."""
    redacted = redact_live(docs)
    return redacted.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("long")).otherwise(F.col("n_chars")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row per piece; a null or empty text is one end id."""
    return pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: Model fitting, fingerprints and tokenizers are not SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
