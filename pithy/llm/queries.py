"""The operators' queries over their whole tables, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pithy.llm.audit import audit_filters
from pithy.llm.chat import conversation_digests, format_conversations
from pithy.llm.decontam import contaminated
from pithy.llm.langid import identify_languages
from pithy.llm.maintext import extract_pages
from pithy.llm.neardup import embedding_components
from pithy.llm.oracle import ORACLES
from pithy.llm.packing import pack
from pithy.llm.passages import remove_repeats, repeat_digests
from pithy.llm.secrets import scan_secrets
from pithy.llm.simhash import simhash_components
from pithy.llm.tokencount import count_tokens
from pithy.llm.topk import top_k
from pithy.llm.whitening import whiten


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return repeat_digests(remove_repeats(read(spark, sf, "documents")))


def op2_secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    """Owners are sources, repositories documents; the pipeline redacts by the same rule."""
    return scan_secrets(read(spark, sf, "documents"))


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_tokens(read(spark, sf, "documents"))


def op4_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return extract_pages(read(spark, sf, "pages"))


def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return identify_languages(read(spark, sf, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_components(read(spark, sf, "embeddings"))


def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(read(spark, sf, "documents"))


def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Without the fingerprints' distance, which SQL cannot tell."""
    return contaminated(read(spark, sf, "documents"), read(spark, sf, "benchmark")).drop("hamming")


def op9_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations, and conversation -1, whose texts hold control strings of the template."""
    rows = read(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], rows.schema)
    return conversation_digests(format_conversations(rows.unionByName(added)))


def op10_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_components(read(spark, sf, "documents"))


def op11_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(read(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whiten(read(spark, sf, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit_filters(read(spark, sf, "documents"), read(spark, sf, "labels"))


__all__ = ["ORACLES", "QUERIES"]

QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_secret_scans, op3_token_counts, op4_html_extraction, op5_language_id,
    op6_embedding_near_dedup, op7_packing, op8_decontamination, op9_chat_formatting, op10_simhash_near_dedup,
    op11_exact_top_k, op12_embedding_whitening, op13_filter_audit,
)}
